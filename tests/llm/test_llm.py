"""The training-data operators against plain versions, exact round trips and edge cases."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import zstandard
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveyloom.llm import best_fit_packing as packing
from surveyloom.llm import bpe, chat_format, embedding_dedup, ngram_join, packed_matrices, quality_rules, queries, repeat_removal, style_tree, tables, token_ids, warc
from surveyloom.llm.components import components
from surveyloom.llm.tables import settled, written
from tests.conftest import same_as_oracle
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, n long, uid long, `a.b` int, `row` int, `starts` int, `c0` int, `text_sha` string"


def docs(spark, rows):
    """Documents with further columns whose names clash with those the operators use inside, one with a dot."""
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 5, 7, 1, 2, 3, 4, "y") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" + rng.choice(["", ",", ".", "\n", "é"]) for _ in range(n))


def edge_texts():
    rng = random.Random(5)
    long = prose(rng, 30_000)
    base = prose(rng, 120)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One two"), (6, base), (7, base), (8, base.upper()),
        (9, base + " tail"), (10, long), (11, long + " end"), (12, "x" * 5000), (13, "ab " * 900), (14, "日本語 テキスト " * 40), (15, "a\x00b\x0bc<|endoftext|>d"),
        (16, "a b c d e"), (17, "a b c d e"), (None, "no id at all here today"),
    ]


# ---- op1 ----


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<float>, label int, raw string, rep int")


def brute_links(rows, threshold=0.93):
    ids = [r[0] for r in rows]
    u, n = brute.Union(ids), dict.fromkeys(ids, 0)
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    for k, (a, x, la) in enumerate(rows):
        for b, y, lb in rows[:k]:
            if la is None or la != lb or not ok(x) or not ok(y) or len(x) != len(y):
                continue
            p, q = np.float32(x).astype(float), np.float32(y).astype(float)
            if p @ q / (np.linalg.norm(p) * np.linalg.norm(q)) >= threshold:
                n[a] += 1
                n[b] += 1
                u.join(a, b)
    return {i: (n[i], u.find(i)) for i in ids}


def test_embedding_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [0.0, 0.0, 0.0], 0), (7, [float("nan"), 1.0, 1.0], 0), (8, [float("inf"), 1.0, 1.0], 0),
            (9, [None, 1.0, 1.0], 0), (10, [2.0, 4.0, 6.0], 0), (11, [], 0), (12, [1.0, 2.0], 0), (13, [-1.0, -2.0, -3.0], 0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(embeddings(spark, rows)).collect()}
    want = {i: (n, c, c == i) for i, (n, c) in brute_links(rows).items()}
    assert got == want
    assert embedding_dedup.near_duplicates(embeddings(spark, [])).count() == 0


def test_huge_and_tiny_vectors(spark):
    rows = [
        (1, [1e200, 1e200]), (2, [1e200, 1e200]), (3, [1e-200, 1e-200]), (4, [3.0, 3.0]), (5, [1e308, -1e308]), (6, [5e-324, -5e-324]), (7, [1e200, 1e-200]), (8, [2.0, 0.0]), (9, [0.0, 0.0]),
        (10, [1e308, 9e307]), (11, [1e-310, 9e-311]),
    ]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    same = {1, 2, 3, 4, 10, 11}
    assert got == {i: (5, 1) if i in same else (1, 5) if i in (5, 6) else (1, 7) if i in (7, 8) else (0, i) for i, _ in rows}


@pytest.mark.parametrize("handed", [1 << 25, 0])
def test_embedding_forest_against_brute_force(spark, monkeypatch, handed):
    # with and without trees that every task gets
    monkeypatch.setattr(embedding_dedup, "HANDED_TREES", handed)
    monkeypatch.setattr(embedding_dedup, "ROUTED", 50)
    use = embedding_dedup.Settings(leaf=24, sample=200, block=32, least_sample=8, recall=0.9999)
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(32)
    x = [rng.standard_normal(32) for _ in range(300)] + [centre + 0.05 * rng.standard_normal(32) for _ in range(90)]
    x += [x[k] + 0.1 * rng.standard_normal(32) for k in range(60)] + [x[k] for k in range(40)]
    rows = [(i, [float(a) for a in v], 0 if i % 7 else 1) for i, v in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(embeddings(spark, rows), use).collect()}
    want = brute_links(rows)
    found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert 0.98 * there <= found <= there and all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)


def test_default_forest_finds_planted_pairs(spark):
    """Pairs right above the threshold among vectors without any order, at the default settings."""
    rng = np.random.default_rng(8)
    n, planted, d = 56_000, 1500, 32
    x = rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    aside = rng.standard_normal((planted, d))
    aside -= (aside * x[:planted]).sum(1)[:, None] * x[:planted]
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    x[planted : 2 * planted] = 0.932 * x[:planted] + np.sqrt(1 - 0.932**2) * aside
    values = pa.ListArray.from_arrays(np.arange(0, n * d + 1, d, dtype=np.int32), x.ravel())
    frame = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "label": np.ones(n, np.int32), "embedding": values}))
    rows, kind = embedding_dedup.prepared(frame)
    reps = written(rows.select(F.col("vec_id").alias("rep"), "root", "raw", F.lit(1).alias("copies")), "reps")
    use = embedding_dedup.Settings(kind=kind)
    cells = written(embedding_dedup.forest(reps, use), "cells")
    assert cells.count() <= 10 * n
    # the two of a pair are rows k and planted + k
    pair = F.col("rep") % planted
    met = cells.where(F.col("rep") < 2 * planted).groupBy(pair.alias("pair"), "cell").count().where("count = 2").select("pair").distinct().count()
    assert met >= 0.99 * planted
    linked = embedding_dedup.near_links(reps, cells, use).where(F.col("rep") < 2 * planted)
    assert linked.groupBy("rep").agg(F.sum("links").alias("n")).where("n = 1").count() == 2 * met


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 100), (200, 300), (300, 200)], "u long, v long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 200: 200, 300: 200}


# ---- op2 ----


def test_pieces_and_places(spark, exact, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 8)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rows = edge_texts()
    out = packing.best_fit_packing(docs(spark, [*rows, (6, rows[5][1])]), 256).collect()
    by_doc, sequences = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in rows:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        copies = 2 if i == 6 else 1
        pieces = sorted(by_doc[i], key=lambda r: r.piece)[::copies]
        at = 0
        for k, r in enumerate(pieces):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.length == 256 or k == 0
            at += r.length
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1.1 * sum(r.length for r in out) / 256 + 2
    assert packing.best_fit_packing(docs(spark, [])).count() == 0


def test_best_fit_never_overfills():
    rng = np.random.default_rng(1)
    for _ in range(50):
        sizes = rng.integers(1, 65, rng.integers(1, 200))
        b, offset, fill = packing.best_fit(sizes, 64)
        assert all(sizes[b == k].sum() == fill[b == k][0] <= 64 for k in range(b.max() + 1))
        assert all(sorted(offset[b == k])[0] == 0 for k in range(b.max() + 1))
        # best fit leaves no two bins that would fit in one
        fills = sorted(int(fill[b == k][0]) for k in range(b.max() + 1))
        assert len(fills) < 2 or fills[0] + fills[1] > 64


@pytest.mark.parametrize("seed", range(4))
def test_what_a_group_hands_on_is_enough(monkeypatch, seed):
    """Handing on more than HOSTS roomy sequences makes no fewer sequences: the group functions over a tree of groups, in this process."""
    rng = random.Random(seed)
    sizes = [min(1023, int(rng.paretovariate(0.7) * (40, 90, 200, 300)[seed])) for _ in range(30_000)]
    found = {}
    for hosts in (packing.HOSTS, 10**6):
        monkeypatch.setattr(packing, "HOSTS", hosts)
        groups = [pd.DataFrame({"item": range(k, 30_000, 27), "size": sizes[k::27]}) for k in range(27)]
        final, level = 0, 0
        while True:
            packed = [packing.packer(1024, level)((k,), g) for k, g in enumerate(groups)]
            bins = [x[x["offset"] == 0] for x in packed]
            if len(groups) == 1:
                break
            final += sum(int((~x["open"]).sum()) for x in bins)
            up = [x[x["open"]].rename(columns={"fill": "size"}).assign(item=x["bin"])[["item", "size"]] for x in bins]
            groups, level = [pd.concat(up[k : k + 3]) for k in range(0, len(up), 3)], level + 1
        found[hosts] = final + len(bins[0])
    assert len(set(found.values())) == 1
    if seed < 2:
        assert max(found.values()) <= 1.02 * sum(sizes) / 1024 + 2


def test_cut():
    assert list(token_ids.cut(10, 4)) == [(0, 2), (2, 4), (6, 4)] and list(token_ids.cut(8, 4)) == [(0, 4), (4, 4)]
    assert list(token_ids.cut(3, 4)) == [(0, 3)] and list(token_ids.cut(1, 4)) == [(0, 1)]


def test_fast_ids_are_the_library_ids(exact):
    rng = random.Random(2)
    alphabet = "abcdefgh ABC  \n\t'0129.,!?éèßäñ¿–—“”…€\xa0\x85ﬁ日🙂"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert token_ids.text_ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids
    assert token_ids.text_ids("a<|endoftext|>b").tolist() == exact.encode("a<|endoftext|>b", add_special_tokens=False).ids


# ---- op3 ----


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string")


def test_warc_round_trip(spark, tmp_path):
    big = "é<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 4000
    rows = [(5, "http://a/x y\r\n", "z" * 200), (3, "http://b", "z" * 200), (4, None, "z" * 99), (9, "http://c", "z" * 99), (7, "u", None), (8, "u", ""), (2, "u", big), (12, "u", big), (1, "u", "é" * 50), (6, "u", "é" * 50)]
    path = f"file://{tmp_path}/w"
    warc.write_warc(pages(spark, [*rows, rows[0], (None, "u", "z" * 200)]), path)
    got = {r.record_id.split(":")[2]: r for r in warc.read_warc(spark, path).collect()}
    assert len(got) == len(rows) + 1 and all(r.complete for r in got.values())
    for i, _, html in rows:
        r, raw = got[str(i)], (html or "").encode()
        assert r.payload_digest == hashlib.sha256(raw).hexdigest()
        if i in (5, 12, 6):
            assert r.record_type == "revisit" and r.payload is None and r.refers_to.split(":")[2] == {5: "3", 12: "2", 6: "1"}[i]
        else:
            assert r.record_type == "response" and bytes(r.payload) == raw and r.refers_to is None
    assert got[""].record_type == "revisit"


def test_warc_has_a_record_for_each_row(spark, tmp_path):
    large, small, other = "z" * 40_000, "s" * 20, "o" * 150
    rows = [(5, "http://b", large), (5, "http://a", large), (5, "http://a", large), (5, None, large), (5, "http://a", other), (7, "http://c", large), (7, "http://c", large)]
    rows += [(8, "u", small), (8, "u", small), (8, "v", small), (None, "u", None), (None, "v", None), (None, "", None), (None, None, None), (None, "u", other), (None, "u", other), (9, "w", None)]
    path = f"file://{tmp_path}/w"
    warc.write_warc(pages(spark, rows), path)
    got = warc.read_warc(spark, path).collect()
    sha = lambda h: hashlib.sha256((h or "").encode()).hexdigest()
    key = lambda i, u, h: (str(i or ""), u or "", sha(h))
    assert sorted((r.record_id.split(":")[2], r.target_uri or "", r.payload_digest) for r in got) == sorted(key(*r) for r in rows)
    ids = {r.record_id: r for r in got}
    assert len(ids) == len(got) == len(rows) and all(r.complete for r in got)
    for r in got:
        if r.record_type == "response":
            assert r.refers_to is None and hashlib.sha256(r.payload).hexdigest() == r.payload_digest
        else:
            assert ids[r.refers_to].record_type == "response" and ids[r.refers_to].payload_digest == r.payload_digest
    responses = [r for r in got if r.record_type == "response"]
    assert sorted(r.payload_digest for r in responses) == sorted([sha(large), sha(other), *[sha(small)] * 3, *[sha("")] * 5])
    assert {r.target_uri for r in responses if r.payload_digest == sha(large)} == {"http://a"}


def test_repeated_pages_match_duckdb(spark, tmp_path):
    import duckdb

    large = "z" * 40_000
    rows = [(5, "http://b", large), (5, "http://a", large), (5, "http://a", large), (3, None, large), (7, "u", None), (7, "u", None), (8, "v", "s" * 99), (9, "v", "s" * 99), (6, "w", "q" * 300)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"file://{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    same_as_oracle(spark, con, f"file://{tmp_path}", "op3", warc.op3_warc, warc.OP3_SQL)


def test_warc_reads_other_archives(spark, tmp_path):
    """Version 1.0, a gzip member for each record, blocks that hold the start of a record, uncompressed files; broken ones are errors."""
    import gzip

    block = b"HTTP/1.0 200 OK\r\n\r\nWARC/1.1\r\nWARC/1.0\r\n\r\nWARC/1.\xff"
    one = lambda k, v="0": b"WARC/1.%b\r\nWARC-Type: response\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (v.encode(), k, len(block), block)
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc.gz").write_bytes(b"".join(gzip.compress(one(k)) for k in range(50)))
    (tmp_path / "w" / "b.warc.gz").write_bytes(gzip.compress(one(50, "1") + one(51)))
    (tmp_path / "w" / "c.warc").write_bytes(one(52) + one(53, "1"))
    (tmp_path / "w" / "notes.txt").write_bytes(b"not an archive")
    got = warc.read_warc(spark, f"file://{tmp_path}/w").collect()
    assert sorted(r.record_id for r in got) == sorted(f"<{k}>" for k in range(54))
    assert {bytes(r.payload) for r in got} == {block.partition(b"\r\n\r\n")[2]}
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(one(1)[:-30]))
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_warc(spark, f"file://{tmp_path}/x.warc.gz").collect()


def test_warc_segments_are_checked():
    block = b"H\r\n\r\nbody"
    part = lambda k, b: {"segment": k, "block": b}
    assert warc.whole_block([part(1, block[:4]), part(2, block[4:])], len(block)) == block
    assert warc.whole_block([part(1, block[:4]), part(3, block[4:])], len(block)) is None
    assert warc.whole_block([part(1, block[:4]), part(2, block[4:])], len(block) + 1) is None
    assert warc.whole_block([part(1, block)], None) is None


@pytest.mark.parametrize(
    "change,message",
    [
        (lambda raw: raw, None),
        (lambda raw: raw.replace(b"word 77,", b"word 78,", 1), "isn't that of its digest"),
        (lambda raw: without(raw, b"WARC-Segment-Number: 2"), "a segment is missing"),
        (lambda raw: without(raw, b"WARC-Segment-Number: 1"), "a segment is missing"),
        (lambda raw: without(raw, b"/first"), "is missing"),
    ],
)
def test_damaged_archives_are_errors(spark, tmp_path, monkeypatch, change, message):
    html = "".join(f"<p>word {k}, </p>" for k in range(2 * warc.SEGMENT // 15))
    small = "<p>first</p>" * 20
    rows = [(1, "http://h/long", html), (2, "http://h/first", small), (3, "http://h/again", small)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    write = warc.write_warc

    def damaged(pages, path):
        write(pages, path)
        for file in sorted((tmp_path / "shared").rglob("*.gz")):
            file.write_bytes(gzip.compress(change(gzip.decompress(file.read_bytes()))))
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)

    monkeypatch.setattr(warc, "shared_dir", lambda _: f"file://{tmp_path}/shared")
    monkeypatch.setattr(warc, "write_warc", damaged)
    if message is None:
        assert {r.page_id: r.record_type for r in warc.op3_warc(spark, str(tmp_path)).collect()} == {1: "response", 2: "response", 3: "revisit"}
    else:
        with pytest.raises(Exception, match=message):
            warc.op3_warc(spark, str(tmp_path)).collect()


def without(raw, mark):
    """An archive without the records whose head holds a mark."""
    out = []
    for record in raw.split(warc.START)[1:]:
        if mark not in record.split(b"\r\n\r\n")[0]:
            out.append(warc.START + record)
    return b"".join(out)


@pytest.mark.parametrize("body,payload", [(b"3\r\nabc\r\n0\r\n\r\n", b"abc"), (b"1;x=y\r\na\r\nA\r\n0123456789\r\n0\r\nT: v\r\n\r\n", b"a0123456789"), (b"3\r\nab", None), (b"zz\r\n", None), (b"3\r\nabcd\r\n0\r\n\r\n", None)])
def test_chunked_framing(body, payload):
    assert warc.unchunked(body) == payload
    assert warc.unchunked(warc.chunked(b"q" * 20_000)) == b"q" * 20_000 and warc.unchunked(warc.chunked(b"")) == b""


def test_warc_of_an_empty_table(spark, tmp_path):
    warc.write_warc(pages(spark, []), f"file://{tmp_path}/none")
    assert warc.read_warc(spark, f"file://{tmp_path}/none").count() == 0


# ---- op4 ----


def check_cut(spark, rows, order=None):
    got = {r.doc_id: r for r in repeat_removal.without_repeats(docs(spark, rows)).collect()}
    for i, raw, gone in brute.cut(order or rows):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(raw), sum(gone), brute.spans(gone)), i
        if r.kept is None:
            assert not any(gone) and r.sha == hashlib.sha256(raw).hexdigest()
        else:
            assert bytes(r.kept) == brute.kept(raw, gone), i
    return got


def test_repeats_edge_cases(spark):
    rows = [r for r in edge_texts() if r[0] is not None]
    check_cut(spark, rows)
    # a null id is the last document
    rows = [(None, rows[5][1] + "!"), *rows[:8]]
    check_cut(spark, rows, [*rows[1:], rows[0]])
    assert repeat_removal.without_repeats(docs(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [1 << 19, 150, 0])
def test_repeats_of_random_texts(spark, monkeypatch, hot):
    # 0: no part is sorted in one task
    monkeypatch.setattr(repeat_removal, "HOT_PLACES", hot)
    monkeypatch.setattr(repeat_removal, "TEXT_A_PARTITION", 20_000)
    monkeypatch.setattr(repeat_removal, "SENT_A_PARTITION", 50_000)
    rng = random.Random(8)
    passages = [prose(rng, rng.randrange(10, 60), 20) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages)[rng.randrange(30) :][: rng.randrange(80, 400)] if rng.random() < 0.6 else prose(rng, rng.randrange(1, 40), 30) for _ in range(rng.randrange(1, 6))]
        rows.append((i, "".join(parts)))
    rows += [(200, "ab" * 400), (201, "abc" * 300 + "x" + "ab" * 100), (202, "a" * 99), (203, "a" * 100), (204, "a" * 100), (205, "a" * 101)]
    rng.shuffle(rows)
    check_cut(spark, rows, sorted(rows))


@pytest.mark.parametrize("hot", [1 << 19, 100])
def test_repeats_of_one_seed_with_many_surroundings(spark, monkeypatch, hot):
    monkeypatch.setattr(repeat_removal, "HOT_PLACES", hot)
    rng = random.Random(12)
    line = prose(rng, 40, 300)[:160]
    # what stands before and behind differs, but shares ends of any length
    ends = [prose(rng, 12, 300)[:50] for _ in range(6)]
    rows = [(i, rng.choice(ends)[rng.randrange(50) :] + line[: rng.randrange(60, 161)] + rng.choice(ends)[: rng.randrange(50)] + str(i)) for i in range(150)]
    # a null id is the last document
    check_cut(spark, [(None, line), *rows[::-1]], [*rows, (None, line)])


def test_cut_texts_keep_whole_characters(spark):
    passage = "".join(chr(0xE0 + k % 30) for k in range(60))
    rows = [(1, "a" + passage), (2, "b" * 30 + passage + "日本"), (3, "b" * 30), (4, "a" + passage)]
    out = {r.doc_id: r for r in repeat_removal.cut_repeats(docs(spark, rows)).collect()}
    assert out[2].text == "b" * 30 + "日本" and out[1].text == "a" + passage and 4 not in out and out[3].uid == 7
    assert repeat_removal.cut_repeats(docs(spark, [])).columns == docs(spark, []).columns


def test_cut_keeps_one_of_repeated_rows(spark):
    rng = random.Random(12)
    one, two, passage, tail = (prose(rng, 60) for _ in range(4))
    rows = [(1, one), (1, one), (2, passage), (3, two + passage), (3, two + passage), (3, two + passage), (4, two + passage)]
    rows += [(None, tail), (None, tail), (None, one), (5, "short"), (5, "short"), (1, tail + "!")]
    got = sorted((r.doc_id or 0, r.text) for r in repeat_removal.cut_repeats(docs(spark, rows)).collect())
    # the text of the null ids is found in document 1 and goes
    assert got == sorted([(1, one), (2, passage), (3, two), (5, "short"), (5, "short"), (1, tail + "!")])
    spans = [(r.doc_id or 0, r.n_removed) for r in repeat_removal.without_repeats(docs(spark, rows)).collect()]
    n = {t: len(t.encode()) for t in (one, two, passage, tail)}
    want = [(1, 0), (1, 0), (1, n[one]), (2, 0), (3, n[passage]), (0, n[tail]), (0, n[tail]), (0, n[one]), (5, 0), (5, 0)]
    assert sorted(spans) == sorted([*want, *[(i, n[two] + n[passage]) for i in (3, 3, 4)]])
    got = repeat_removal.cut_repeats(docs(spark, [(None, tail), (None, tail), (7, one)])).collect()
    assert sorted((r.doc_id or 0, r.text, r.uid) for r in got) == sorted([(0, tail, 7), (7, one, 7)])


def test_intervals_are_the_common_prefix_tree():
    rng = random.Random(4)
    for _ in range(200):
        lcp = [rng.randrange(5) for _ in range(rng.randrange(12))]
        got = set(repeat_removal.intervals(lcp, 1))
        want = set()
        for a in range(len(lcp)):
            for b in range(a, len(lcp)):
                v = min(lcp[a : b + 1])
                if v >= 1 and (a == 0 or lcp[a - 1] < v) and (b == len(lcp) - 1 or lcp[b + 1] < v):
                    want.add((a, b + 1, v))
        assert got == want


# ---- op5 ----


class ListOf(AccumulatorParam):
    def zero(self, value):
        return []

    def addInPlace(self, one, other):
        return one + other


def check_join(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs(spark, rows)).collect()}
    assert got == brute.jaccard_components(rows)


def test_join_edge_cases(spark):
    rows = [r for r in edge_texts() if r[0] is not None]
    check_join(spark, rows)
    got = ngram_join.jaccard_components(docs(spark, [(None, "a b c d e f"), (4, "A b c d e f"), (4, "a b c d e f"), (None, "")])).collect()
    assert sorted((r.doc_id is None, r.n_shingles, r.component_id) for r in got if r.n_shingles) == [(False, 2, 4), (False, 2, 4), (True, 2, 4)]
    assert ngram_join.jaccard_components(docs(spark, [])).count() == 0


def test_join_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "TEXT_A_PARTITION", 20_000)
    rng = random.Random(11)
    seeds = [prose(rng, rng.randrange(4, 80), 40).split() for _ in range(15)]
    rows = []
    for i in range(160):
        words = list(rng.choice(seeds))
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    check_join(spark, rows)


def test_a_task_holds_one_pair_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    sizes = spark.sparkContext.accumulator([], ListOf())
    whole = ngram_join.links_of_groups

    def links(key, rows):
        sizes.add([(rows.groupby(["cand", "low", "high"]).ngroups, len(rows))])
        return whole(key, rows)

    monkeypatch.setattr(ngram_join, "links_of_groups", links)
    rng = random.Random(15)
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*words[:rng.randrange(50, 60)], f"own{i}"])) for i in range(300)]
    check_join(spark, rows)
    # 38 blocks of about 8: each task one pair, no more rows than two blocks can have
    assert len(sizes.value) > 300 and all(n == 1 for n, _ in sizes.value) and max(k for _, k in sizes.value) < 60


def test_blocks_of_long_sets_and_of_chains_are_bounded(spark, monkeypatch):
    """A chain of sets, each like the next only, and long sets: blocks and tasks hold so many bytes, whatever the number of sets."""
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(ngram_join, "BYTES_A_TASK", 20_000)
    sizes = spark.sparkContext.accumulator([], ListOf())
    whole = ngram_join.links_of_groups

    def links(key, rows):
        sizes.add([(rows.groupby(["cand", "low", "high"]).ngroups, int(rows["keys"].map(len).sum()))])
        return whole(key, rows)

    monkeypatch.setattr(ngram_join, "links_of_groups", links)
    rng = random.Random(16)
    words = [f"w{k}" for k in range(1300)]
    rows = [(i, " ".join(words[10 * i : 10 * i + 100])) for i in range(120)]
    long = [f"v{k}" for k in range(900)]
    rows += [(200 + i, " ".join([*long, f"own{i}"])) for i in range(12)] + [(300 + i, f"{rng.random()} b c d e f g") for i in range(30)]
    check_join(spark, rows)
    # two blocks of about 20,000 bytes, or the small groups of a task; the longest set has 7,200
    assert len(sizes.value) > 10 and max(b for _, b in sizes.value) < 60_000


def test_input_behind_a_shuffle_is_written_first(spark):
    rows = docs(spark, [(1, "a b c d e f"), (2, "a b c d e f")])
    assert settled(rows, "t") is rows
    again = settled(rows.repartition(3, "doc_id"), "t")
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and again.count() == 2


def test_long_texts_are_handed_over_by_bytes(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    monkeypatch.setattr(tables, "HANDED_BYTES", 50_000)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows = docs(spark, [(i, "x" * 1000) for i in range(900)] + [(900, "x" * 200_000)]).coalesce(1)
    found = [r.n for r in written(rows.select("text").mapInArrow(sizes, "n long"), "t").collect()]
    assert sum(found) == 901 and max(found) <= 60
    assert spark.conf.get(key, None) == before


def test_one_of_each_group_stays(spark):
    rows = edge_texts()
    left = ngram_join.keep_one_of_each(docs(spark, [*rows, (16, "a b c d e")]))
    want = brute.jaccard_components([r for r in rows if r[0] is not None])
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(i for i, (_, c) in want.items() if c == i)
    assert left.where("doc_id IS NULL").count() == 1 and left.columns == docs(spark, []).columns


def test_one_of_each_group_stays_by_row(spark):
    rng = random.Random(14)
    a, b, c, d, e, f = (prose(rng, 60).replace("é", "") for _ in range(6))
    rows = [(3, a), (7, a), (7, b), (8, c), (8, c + " tail"), (9, d), (9, d.upper()), (None, e), (None, e), (None, e + " tail"), (None, f), (5, f), (None, b + " tail")]
    rows += [(6, ""), (6, ""), (None, ""), (None, None)]
    for order in (rows, rows[::-1]):
        left = ngram_join.keep_one_of_each(docs(spark, order))
        got = sorted((r.doc_id or 0, (r.text or "").lower().removesuffix(" tail")) for r in left.collect())
        assert got == sorted([(3, a), (7, b), (8, c), (9, d.lower()), (0, e), (5, f), (6, ""), (0, ""), (0, "")]) and left.columns == docs(spark, []).columns
    assert ngram_join.keep_one_of_each(docs(spark, [])).count() == 0


@pytest.mark.parametrize("numbers", [[], [0], [0, 0, 254, 255, 255, 510, 511], [70_000, 70_000, 70_765], [255], [254]])
def test_gaps_round_trip(numbers):
    from surveyloom.llm.blocks import from_gaps, gaps

    assert from_gaps(gaps(np.array(numbers, np.int32))).tolist() == numbers


def test_trie_against_all_pairs():
    rng = random.Random(6)
    for _ in range(60):
        base = [rng.sample(range(40), 20) for _ in range(3)]
        sets = [np.array(sorted({*rng.sample(rng.choice(base), rng.randrange(12, 20)), *rng.sample(range(60), 2)}), np.uint64) for _ in range(25)]
        sizes = np.array([len(s) + rng.randrange(2) for s in sets])
        side = np.array([rng.random() < 0.5 for _ in sets]) if rng.random() < 0.5 else None
        u = brute.Union(range(25))
        for a in range(25):
            for b in range(a):
                o = len(np.intersect1d(sets[a], sets[b]))
                if (side is None or side[a] != side[b]) and 100 * o >= 75 * (sizes[a] + sizes[b] - o):
                    u.join(a, b)
        assert ngram_join.trie_links(sets, sizes, side).tolist() == [u.find(k) for k in range(25)]


# ---- op6 ----


def test_quality_counts(spark):
    rng = random.Random(9)
    rows = [r for r in edge_texts() if r[0] not in (10, 11)] + [(100 + k, prose(rng, rng.randrange(0, 120), rng.choice([5, 300])) + "\n#a *b\n#a *b") for k in range(30)]
    for r in quality_rules.quality_rules(docs(spark, rows)).collect():
        text = dict(rows)[r.doc_id]
        want = brute.quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(docs(spark, [])).count() == 0


def test_compression_bands_equal_a_plain_version():
    rng = random.Random(5)
    squeeze = zstandard.ZstdCompressor(level=quality_rules.ZSTD_LEVEL).compress
    noise = lambda n: bytes(rng.randrange(33, 127) for _ in range(n))
    raws = [b"", b"a", b"q" * 4096, b"q" * 4095, noise(4096) + prose(rng, 600, 3000).encode()]
    for _ in range(120):
        parts = [rng.choice((noise(rng.randrange(1, 5000)), prose(rng, rng.randrange(1, 900), 3000).encode(), b"to be or not " * rng.randrange(1, 400))) for _ in range(rng.randrange(1, 4))]
        raws.append(b"".join(parts))
    verdicts = [quality_rules.compression(x, squeeze)[0] for x in raws]
    assert verdicts == [brute.within_bands(x) for x in raws] and len(set(verdicts)) == 2
    # the last chunk counts by its bytes
    good = prose(rng, 1200, 3000).encode()[:5000]
    assert quality_rules.compression(good, squeeze)[2:] == (0, 2) and quality_rules.compression(good[:4096] + noise(900), squeeze)[2:] == (1, 2)


def test_limits_are_fitted_to_all_good_documents(spark):
    rng = random.Random(61)
    letters = "abcdefghijklmnopqrstuvwxyz"
    drawn = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    rows = [(k, drawn(rng.choice([60, 300, 900, 3000, 9000, 40_000]), letters[: rng.randrange(4, 26)] + " ")) for k in range(60)] + [(90, "a" * 5000), (91, drawn(9000, "".join(map(chr, range(256, 900))))), (92, None), (93, "")]
    good = spark.createDataFrame([(k, 1) for k in range(60)] + [(92, 1), (93, 1), (500, 1)], "doc_id long, quality int")
    fitted = quality_rules.fit_limits(docs(spark, rows).repartition(4), good, margin=0.01)
    squeeze = zstandard.ZstdCompressor(level=quality_rules.ZSTD_LEVEL).compress
    raws = [t.encode() for _, t in rows[:60]]
    top = max(len(x) / len(squeeze(x)) * 1.01 - 0.1 * quality_rules.doublings(len(x)) for x in raws)
    assert fitted.repetitive_base == pytest.approx(top) and fitted.repetitive_step == 0.1
    for k, (low, high) in enumerate([(0, 512), (512, 2048), (2048, 1 << 40)]):
        assert fitted.incompressible[k][1] == pytest.approx(min(len(x) / len(squeeze(x)) for x in raws if low <= len(x) < high) * 0.99)
    # all good documents keep the limits fitted to them, the others don't
    assert all(quality_rules.compression(x, squeeze, fitted)[0] for x in raws)
    assert not quality_rules.compression(rows[60][1].encode(), squeeze, fitted)[0]
    judged = {r.doc_id: r.n_chunks for r in quality_rules.quality_rules(docs(spark, rows), fitted).collect()}
    assert judged[90] == 2 and {r.doc_id for r in quality_rules.keep_good(docs(spark, rows), fitted).collect()} <= set(range(60))
    assert quality_rules.fit_limits(docs(spark, []), good) == quality_rules.Limits()


def test_quality_of_a_very_long_text(spark):
    rng = random.Random(62)
    long = prose(rng, 400_000, words=60_000)
    (row,) = quality_rules.quality_rules(docs(spark, [(1, long)])).collect()
    words = quality_rules.WORD.findall(long)
    assert (row.n_words, row.word_chars, row.n_chunks) == (len(words), sum(map(len, words)), -(-len(long.encode()) // 4096)) and not row.base_failed
    assert row.n_dup_lines == brute_lines(long)


def brute_lines(text):
    lines = [x for x in text.split("\n") if quality_rules.WORD.search(x)]
    return len(lines) - len(set(lines))


def test_compression_bands(spark):
    rng = random.Random(1)
    import base64

    noise = " ".join(base64.b64encode(rng.randbytes(9)).decode() for _ in range(900))
    letters = "etaoinshrdlu"
    good = " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(700))
    # repetitive without any three-word window found twice
    vocabulary = ["interconnectedness", "institutionalising", "misrepresentations"]
    dull = " ".join(rng.choice(vocabulary) + str(k % 10) for k in range(700))
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs(spark, [(1, noise), (2, good), (3, dull)])).collect()}
    assert not got[1].kept and got[2].kept and not got[3].kept
    kept = quality_rules.keep_good(docs(spark, [(1, noise), (2, good)]))
    assert [r.doc_id for r in kept.collect()] == [2] and kept.columns == docs(spark, []).columns


# ---- op7 ----


def test_bpe_is_the_library(spark, exact):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(3)
    codec = bpe.BytePairCodec(path)
    ascii_pieces = [b.decode() for b in codec.bytes_of.values() if max(b) < 128]
    rows = edge_texts() + [(100 + k, "".join(rng.choice(ascii_pieces) for _ in range(30))) for k in range(100)]
    encoded = bpe.bpe_encode(docs(spark, rows), path)
    for r in bpe.bpe_decode(encoded, path).collect():
        text = dict(rows)[r.doc_id] or ""
        ids = exact.encode(text, add_special_tokens=False).ids
        assert r.ids == ids and r.text == exact.decode(ids, skip_special_tokens=False)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(6)]
        assert codec.decode(ids) == exact.decode(ids, skip_special_tokens=False)
    assert bpe.bpe_encode(docs(spark, []), path).count() == 0


def test_every_token_of_the_vocabulary(exact):
    codec = bpe.BytePairCodec(public_tokenizers.path("byte_bpe_50k.json"))
    for raw in list(codec.bytes_of.values())[:20_000:7]:
        text = raw.decode("utf-8", "ignore")
        assert codec.encode(text) == exact.encode(text, add_special_tokens=False).ids


# ---- op8 ----


def test_matrices_hold_every_document(spark, exact, tmp_path):
    rows = edge_texts()
    packed_matrices.write_matrices(docs(spark, rows), f"file://{tmp_path}/m", 128)
    out = packed_matrices.read_matrices(spark, f"file://{tmp_path}/m", 128).collect()
    with pytest.raises(Exception, match="isn't whole"):
        packed_matrices.read_matrices(spark, f"file://{tmp_path}/m", 64).collect()
    got = {}
    for r in out:
        ids, cu = np.frombuffer(r.ids, "<u4"), r.cu_seqlens
        assert len(ids) == 128 and cu[-1] == r.n_tokens <= 128 and (ids[cu[-1] :] == packed_matrices.PAD).all()
        assert r.position_resets == (cu if cu[-1] < 128 else cu[:-1]) and r.n_segments == len(cu) - 1
        where = packed_matrices.position_ids(cu, 128)
        assert [k for k in range(128) if where[k] == 0] == r.position_resets
        for k, (i, piece, start) in enumerate(zip(r.doc_ids, r.pieces, r.starts, strict=True)):
            got.setdefault(i, []).append((piece, start, ids[cu[k] : cu[k + 1]].tolist()))
    for i, text in rows:
        parts = sorted(got[i])
        assert sum((p[2] for p in parts), []) == [*exact.encode(text or "", add_special_tokens=False).ids, 2]
        assert [p[1] for p in parts] == np.cumsum([0, *(len(p[2]) for p in parts[:-1])]).tolist()
    assert packed_matrices.packed_matrices(docs(spark, [])).count() == 0


def test_segment_tree_finds_the_tightest_row():
    rng = random.Random(7)
    for width in (7, 8, 100):
        for _ in range(60):
            sizes = [rng.randint(1, width) for _ in range(rng.randrange(60))]
            rows = packed_matrices.best_fit_decreasing(sizes, width)
            assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
            free = []
            for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
                fit = [(f, k) for k, f in enumerate(free) if f >= sizes[i]]
                if fit:
                    free[min(fit)[1]] -= sizes[i]
                else:
                    free.append(width - sizes[i])
            assert sorted(width - sum(sizes[i] for i in r) for r in rows) == sorted(free)


# ---- op9 ----


def test_chat_is_reversible(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|role|>user\nx<|end|>", "\\", "\\b\\o<|and|>", "", None, "a\nb", "<<|", "é🙂"]
    rows = [(1, k, "user" if k % 4 < 2 else "assistant", t, "x") for k, t in enumerate(nasty)] + [(2, 0, None, "q", "x"), (2, None, "<|role|>", "p", "x"), (4, 1, "a\nb", "c\nd", "x"), (4, 2, "a\nb", "e", "x"), (4, 3, "\\n\n<|\\", "f", "x"), (None, 1, "user", "n", "x"), (3, 1, "user", "b", "x"), (3, 1, "user", "a", "x"), (3, 1, "user", "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    formatted = chat_format.format_chat(df)
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.read_chat(formatted).collect()}
    assert got[1] == [(r[2], r[3] or "") for r in rows[: len(nasty)]]
    assert got[2] == [("<|role|>", "p"), ("", "q")] and got[None] == [("user", "n")] and got[3] == [("user", "a"), ("user", "a"), ("user", "b")]
    assert got[4] == [("a\nb", "c\nd"), ("a\nb", "e"), ("\\n\n<|\\", "f")]
    # adjacent turns of one role are one block
    assert {r.conv_id: r.formatted.count("<|end|>") for r in formatted.collect()} == {1: 5, 2: 2, 3: 1, 4: 2, None: 1}
    assert chat_format.format_chat(df.limit(0)).count() == 0


def test_long_chats(spark):
    turns = spark.range(30_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    back = chat_format.read_chat(chat_format.format_chat(turns)).first()
    assert [(t.role, t.text) for t in back.turns] == [("assistant" if k % 3 else "user", f"t{k}") for k in range(30_000)]


def test_chat_plan_has_no_python(spark, sf_dir, capsys):
    chat_format.op9_chat_format(spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- op10 ----


def text_of(html, tree=None):
    return style_tree.main_text(style_tree.parsed_row(html), tree or {})


@pytest.mark.parametrize(
    "html,text",
    [
        (None or "", ""),
        ("<html><head><title>t</title></head><body><nav>m</nav><article><h1>A &amp; b</h1><p>c <i>d</i>e<br>f<p>g</article><footer>x</footer>", "A & b c de f g"),
        ('<body class="no-sidebar"><div class="wrap-header"><article>a<p>b</article></div><article class="comment">much longer text of a reader</article>', "a b"),
        ('<article>a <span class="ad">buy</span>b<aside>s</aside><div id="comments">c</div><form>f</form><header><h2>d</h2></header></article>', "a b d"),
        ('<script>var t="</p>";</script><p>x &lt; y  &nbsp; z</p><!-- c > --><style>p{}</style>', "x < y z"),
        ("<form><main><p>hi</p></main></form>", "hi"),
        ("<p>fo<b>o</b>l</p>\n a < b <p title='a>b'>q", "fool a < b q"),
        ("<article>short</article><article>the longest article here</article>", "short the longest article here"),
        # names that say more than noise, short articles, and the main part beside an article
        ('<article><div class="related-work"><p>a</p></div><section id="copyright-law">b</section><div id="social-history">c</div><p class="share-price">d</p></article>', "a b c d"),
        ('<article><div class="related-posts"><p>a</p></div><section id="share_buttons">b</section><div id="comments-area2">c</div><p class="Sponsored">d</p>e</article>', "e"),
        ("<article>" + "one " * 20 + "</article><article>" + "two " * 90 + "</article>", ("one " * 20 + "two " * 90).strip()),
        ("<nav>n</nav><main><p>before</p><article>a b c</article><p>after</p><div class=comments>r</div></main><p>out</p>", "before a b c after"),
        ("<div><p hidden>no</p><p>yes</p></div><div role='navigation'>n</div>", "yes"),
        ("<article><p>unclosed <b>tag", "unclosed tag"),
        ("</div></p><<>< /p><a href=", "<<>< /p><a href="),
        # wrappers by any name keep what they hold
        ('<body><div class="layout has-sidebar"><p>a</p><div class=sidebar>s</div></div>', "a"),
        ('<body><form id="aspnetForm"><nav>n</nav><div><p>a</p></div></form>', "a"),
        ('<body><div id="content" class="no-comments"><p>a</p></div><div id=comments><p>c</p></div>', "a"),
        ('<body><main><div class="post with-header"><p>a</p></div></main>', "a"),
        ('<div class="sidebar layout"><p>a b c d e f g h i j k l m</p></div>.', "a b c d e f g h i j k l m ."),
        ('<div class="widget"><article>a a a a</article></div><div class="related"><article>b</article></div>', "a a a a"),
        # beside a clean article
        ('<article class="post comments-open">a</article><div class="related"><article>b</article></div><div>out</div><h2>out</h2>', "a"),
        ("<article>" + "one " * 9 + "</article><article>" + "two " * 9 + "</article>", ("one " * 9 + "two " * 9).strip()),
        ('<nav><p>n</p></nav><div class="ad">only an advert</div><article></article><footer>f</footer>', ""),
        ('<article><p>short</p></article><div id="comments">' + "<p>much longer comments</p>" * 20 + "</div>", "short"),
        ('<div><p>short</p></div><div id="comments">' + "<p>longer comments</p>" * 3 + "</div>", "short"),
    ],
)
def test_main_text(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize(
    "html,text",
    [
        ('<div style="overflow: hidden"><article>a <a title="A hidden gem">b</a></article></div>', "a b"),
        ("<p title='x class=ad id=footer'>a</p><p data-hidden=1>b</p><p hidden-x>c</p><p aria-hidden='true'>d</p><p title=/hidden>e</p>", "a b c d e"),
        ('<p title = "a hidden gem">a</p><p title="A hidden>b</p><p hidden">c', "a c"),
        ("<p>a</p><p title=''hidden>b</p><p/hidden>c</p><p HIDDEN=''>d</p><p title=x\nclass = ad>e</p>", "a"),
    ],
)
def test_attributes_are_read_whole(html, text):
    assert text_of(html) == text


def test_style_tree_removes_what_a_site_repeats(spark):
    rng = random.Random(2)
    row = lambda k, host: (k, f"http://{host}/p{k}", f"<div class=x><p class=q>Same words on each page of the site</p><div class=body><p>{prose(rng, 60)}</p></div></div>", "x")
    schema = "page_id long, url string, html string, host string"
    df = spark.createDataFrame([row(k, "a.example") for k in range(20)] + [row(90, "few.example"), (91, None, None, "x")], schema)
    got = {r.page_id: r.text for r in style_tree.extract_main_text(df).collect()}
    assert all(not got[k].startswith("Same words") and len(got[k]) > 100 for k in range(20))
    assert got[90].startswith("Same words") and got[91] == ""
    # a site whose pages are all alike gives no evidence
    alike = spark.createDataFrame([(k, "http://b/", "<div><p>the same article</p></div>", "x") for k in range(20)], schema)
    assert {r.text for r in style_tree.extract_main_text(alike).collect()} == {"the same article"}
    assert style_tree.extract_main_text(df.limit(0)).count() == 0


def site(rng, m, words=90):
    """Pages of one site without any name that tells a purpose: menu, notice, article, list of links, footer."""
    menu = "".join(f"<li class=z{rng.randrange(2)}>{prose(rng, 2)}</li>" for _ in range(rng.randrange(2, 6)))
    notice, foot = prose(rng, 12), prose(rng, 9)
    pages, articles = [], []
    for _ in range(m):
        parts = [("h1", prose(rng, 5))] + [("p", prose(rng, rng.randrange(8, words))) for _ in range(rng.randrange(1, 8))]
        parts = [(t, " ".join(x.split())) for t, x in parts]
        body = "".join(f"<{t}>{x}</{t}>" for t, x in parts)
        links = "".join(f"<p class=l>{rng.choice(notice.split())}</p>" for _ in range(rng.randrange(3)))
        html = f"<body><div class=a><ul>{menu}</ul></div><div class=b><p>{notice}</p></div><div class=c><div class=d>{body}</div><div class=e>{links}</div></div><div class=f>{foot}</div></body>"
        pages.append(" ".join(html.split()))
        articles.append(" ".join(x for _, x in parts))
    return pages, articles


@pytest.mark.parametrize("few", [True, False])
def test_style_tree_against_a_plain_one(spark, monkeypatch, few):
    monkeypatch.setattr(style_tree, "BROADCAST_NODES", 1000 if few else 0)
    rng = random.Random(31)
    rows, want, article = [], {}, {}
    for k, m in enumerate([1, 2, 3, 5, 12, 40]):
        pages, articles = site(rng, m)
        tree = brute.style_tree(pages)
        for j, html in enumerate(pages):
            i = 100 * k + j
            rows.append((i, f"http://h{k}.example/{j}", html, "x"))
            want[i], article[i] = brute.site_text(html, tree), articles[j]
        got = sorted((round(r.content, 9), round(r.layout, 9)) for r in style_tree.node_importance(style_tree.parsed_pages(pages_of(spark, rows[-m:]))).collect())
        assert got == sorted((round(c, 9), round(v, 9)) for _, c, v in tree.values())
    got = {r.page_id: r.text for r in style_tree.extract_main_text(pages_of(spark, rows)).collect()}
    assert got == want
    # without the tree everything stays; with enough pages only the article and a word or two of the changing links do
    assert all(got[i].startswith(article[i]) and len(got[i]) < len(article[i]) + 20 < len(text_of(html)) for i, _, html, _ in rows if i >= 400)
    assert got[0] == text_of(rows[0][2]) != article[0]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_notices_in_articles(spark):
    """Where pages have an article the tree removes what a site repeats in it, and leaves labels, tables and lists whole."""
    rng = random.Random(34)
    notice = " ".join(prose(rng, 14).split())
    rows, pages = [], []
    for k in range(20):
        text = lambda n: " ".join(prose(rng, n).split())  # noqa: E731, B023
        table = "<table><tbody>" + "".join(f"<tr><th>{name}</th><td>{text(3)}</td></tr>" for name in ("Population", "Area")) + "</tbody></table>"
        terms = "<dl>" + "".join(f"<dt>{name}</dt><dd>{text(6)}</dd>" for name in ("First seen", "Last seen")) + "</dl>"
        steps = "<h2>Ingredients</h2><ul>" + f"<li>salt</li><li>{text(4)}</li>" + "</ul>"
        pages.append(f"<body><article><h1>{text(4)}</h1><p>{text(40)}</p><div class=k><p>{notice}</p></div>{table}{terms}{steps}<p>{text(30)}</p></article></body>")
        rows.append((k, f"http://h/{k}", pages[-1], "x"))
    got = {r.page_id: r.text for r in style_tree.extract_main_text(pages_of(spark, rows)).collect()}
    tree = brute.style_tree(pages)
    assert got == {k: brute.site_text(html, tree) for k, html in enumerate(pages)}
    for k, html in enumerate(pages):
        # everything but the notice, which one page alone would keep
        assert notice in text_of(html) and got[k] == text_of(html.replace(f"<div class=k><p>{notice}</p></div>", ""))
        assert all(x in got[k] for x in ("Population", "Area", "First seen", "Last seen", "Ingredients", "salt"))


def test_rare_noise_does_not_take_an_article(spark):
    """Half of a site's pages are copies of one page: what they share stays, being no less worth than what stands beside it."""
    rng = random.Random(33)
    pages, articles = site(rng, 20)
    rows = [(k, "http://h/", pages[0 if k < 10 else k], "x") for k in range(20)]
    got = {r.page_id: r.text for r in style_tree.extract_main_text(pages_of(spark, rows)).collect()}
    assert all(got[k].startswith(articles[0 if k < 10 else k]) and len(got[k]) < len(articles[0 if k < 10 else k]) + 20 for k in range(20))


def test_long_pages():
    n = 20_000
    assert len(text_of("<article>" + "<p>x <b>y</b></p>" * n + "</article>").split()) == 2 * n
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


# ---- all ----


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_duckdb(spark, duck, sf_dir, name):
    same_as_oracle(spark, duck, sf_dir, name, queries.QUERIES[name], queries.ORACLES[name])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_query_columns(spark, sf_dir):
    want = {
        1: {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
        2: {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
        4: {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
        5: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
        7: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
        10: {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
        11: {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
        12: {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
        13: {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
    }
    for name, f in queries.QUERIES.items():
        types = want.get(int(name[2:].split("_")[0]))
        if types:
            df = f(spark, sf_dir)
            assert types.items() <= dict(df.dtypes).items(), name
            assert df.where(F.lit(True)).count() > 0
