"""Each stage of the corpus pipeline against a plain version of what it should do with its own input."""

import random
import zlib

import numpy as np
import zstandard

import corpus_pipeline
from surveyloom.llm import quality_rules
from surveyloom.llm.tables import written
from tests.llm import brute
from tests.llm.test_llm import docs, exact, prose  # noqa: F401


def corpus():
    rng = random.Random(21)
    passage = prose(rng, 60)
    rows = []
    for i in range(40):
        text = prose(rng, rng.randrange(60, 200))
        rows.append((i, text + " " + passage if i % 4 == 0 else text))
    rows += [(50 + k, rows[k][1]) for k in range(5)]  # exact copies
    rows += [(60 + k, rows[k][1] + " and more") for k in range(5)]  # near copies
    rows += [(70, None), (71, ""), (72, "too short"), (73, "again and again " * 60), (74, passage)]
    return rows


def test_stages(spark, exact):  # noqa: F811
    frame = docs(spark, corpus())
    texts = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    squeeze = zstandard.ZstdCompressor(level=quality_rules.ZSTD_LEVEL).compress
    now = corpus()
    steps = dict(corpus_pipeline.STAGES)

    frame = written(steps["quality_rules"](spark, frame, ""), "t")
    now = [(i, t) for i, t in now if not (brute.quality(t)[0] < 50 or 100 * brute.quality(t)[4] > 50 * brute.quality(t)[0])]
    now = [(i, t) for i, t in now if quality_rules.compression(t.encode(), squeeze)[0]]
    assert texts(frame) == sorted(now) and 73 not in dict(now) and len(now) > 30

    frame = written(steps["ngram_join"](spark, frame, ""), "t")
    groups = brute.jaccard_components(now)
    now = [(i, t) for i, t in now if groups[i][1] == i]
    assert texts(frame) == sorted(now) and not {50, 60} & set(dict(now))

    frame = written(steps["suffix_array_dedup"](spark, frame, ""), "t")
    now = [(i, brute.kept(raw, gone).decode("utf-8", "ignore")) for i, raw, gone in brute.cut(sorted(now))]
    now = [(i, t) for i, t in now if t]
    assert texts(frame) == sorted(now) and frame.columns == docs(spark, []).columns
    assert {r.n_chars == len(r.text) for r in frame.collect()} == {True}

    pieces = steps["best_fit_packing"](spark, frame, "").collect()
    length = {}
    for r in pieces:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    assert length == {i: len(exact.encode(t, add_special_tokens=False).ids) + 1 for i, t in now}
    total = sum(length.values())
    assert len({r.sequence_id for r in pieces}) <= total // 1024 + 2


def plain_run(rows, exact):  # noqa: F811
    """{doc_id: ids} of what is packed."""
    squeeze = zstandard.ZstdCompressor(level=quality_rules.ZSTD_LEVEL).compress
    counts = {i: brute.quality(t) for i, t in rows}
    good = [(i, t) for i, t in rows if counts[i][0] >= 50 and 100 * counts[i][4] <= 50 * counts[i][0] and quality_rules.compression(t.encode(), squeeze)[0]]
    groups = brute.jaccard_components(good)
    one = sorted((i, t) for i, t in good if groups[i][1] == i)
    left = [(i, brute.kept(raw, gone).decode("utf-8", "ignore")) for i, raw, gone in brute.cut(one)]
    return {i: [*exact.encode(t, add_special_tokens=False).ids, 2] for i, t in left if t}


def test_run_is_the_composed_plain_version(spark, exact, tmp_path):  # noqa: F811
    rows = corpus()
    docs(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = plain_run(rows, exact)
    assert all(len(ids) <= 1024 for ids in want.values()) and len(want) > 20
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted((i, 0, 0, len(ids), crc(ids)) for i, ids in want.items())
    # sequences are gapless and not too many
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), [*sorted(own)[1:], (sum(n for _, n in own), 0)], strict=True)) and min(own)[0] == 0
        assert sum(n for _, n in own) <= 1024
    assert len(places) <= sum(map(len, want.values())) // 1024 + 2


def test_run_of_an_empty_table(spark, tmp_path):
    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).where("length > 0").count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 4
