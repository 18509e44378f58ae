"""Line dedup, spelling variants and hard negatives against plain versions, and their edge cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import hard_negatives, line_dedup, queries, spelling_variants
from tests.llm.test_llm import docs, edge_texts

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


# ---- op11 ----


def plain_lines(rows, documents=10, characters=1):
    """[(id, kept text, lines, dropped)] of rows (id, text)."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(i)
    gone = {k for k, ids in held.items() if len(ids) >= documents and len(k) >= characters}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in gone]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def line_texts():
    rng = random.Random(11)
    common = ["Share this", "  share THIS\t", "ÀB c", "àB c", "", " \t", "日本 語", "a\x00b", "x\r", " y"]
    rows = [(k, "\n".join(rng.choice([*common, f"line {rng.randrange(60)}"]) for _ in range(rng.randrange(12)))) for k in range(120)]
    # one line in a third of all rows, a whole text that goes, many copies of a text, repeated rows and ids
    rows += [(200 + k, "only this line here") for k in range(90)]
    rows += [(300, "again\nShare this\nagain\nown line")] * 30 + [(300, "of the same id"), (301, "nine"), *[(302 + k, "nine") for k in range(8)]]
    rows += [(None, "no id\nshare this")] * 12
    return rows + edge_texts()


@pytest.mark.parametrize("most", [10_000, 3])
def test_lines_against_a_plain_version(spark, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "MOST_HOT", most)
    rows = line_texts()
    found = line_dedup.drop_common_lines(docs(spark, rows).repartition(5))
    assert ordered(found.collect()) == ordered(plain_lines(rows))


def test_line_limits(spark):
    rows = line_texts()
    found = line_dedup.drop_common_lines(docs(spark, rows), documents=3, characters=0)
    assert ordered(found.collect()) == ordered(plain_lines(rows, 3, 0))


def test_repeated_ids_count_once(spark):
    rows = [(1, "a line")] * 20 + [(k, "b line") for k in range(2, 12)]
    assert {r.doc_id: r.text for r in line_dedup.drop_common_lines(docs(spark, rows)).collect()} == {1: "a line", **{k: "" for k in range(2, 12)}}


def test_lines_of_long_texts(spark):
    long = "\n".join(f"{k % 7919} of many" if k % 3 else "shared" for k in range(300_000))
    rows = [(1, long), *[(k, "Shared") for k in range(2, 11)]]
    assert ordered(line_dedup.drop_common_lines(docs(spark, rows)).collect()) == ordered(plain_lines(rows))


def test_no_lines(spark):
    assert line_dedup.drop_common_lines(docs(spark, [])).collect() == []


# ---- op12 ----


def plain_words(rows, letters=5, times=3):
    """{word: n} of rows (id, text), damaged as the query does."""
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= letters and c >= times}


def one_letter(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain_forms(words):
    near = {w: [x for x in words if one_letter(w, x)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return out


def word_counts(seed, n):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))): rng.choice([3, 4, 6, 7, 12, 25, 50, 100]) for _ in range(n)}
    # a chain of forms, one anagram class, repeated letters, a long word and its variants
    words |= {"chain" + "x" * k: 3 * 2**k for k in range(12)}
    words |= {w: 9 for w in ("aabbb", "ababb", "abbab", "bbbaa", "babab", "aaaaa", "aaaaaa", "aaaaaaa", "aaaab", "baaaa")}
    long = "".join(rng.choice("abcdefgh") for _ in range(3000))
    return words | {long: 8, long + "z": 30, "q" + long[1:]: 16, "t" * 5000: 5, "t" * 5001: 11}


@pytest.mark.parametrize("most", [10_000, 2])
def test_forms_against_a_plain_version(spark, monkeypatch, most):
    monkeypatch.setattr(spelling_variants, "MOST_HOT", most)
    words = word_counts(most, 400)
    frame = spark.createDataFrame([(w, n, 1, 2) for w, n in words.items()], "word string, n long, `a.b` int, key int").select("word", "n")
    assert ordered(spelling_variants.spelling_variants(frame).collect()) == ordered(plain_forms(words))


def test_words_are_counted_and_damaged(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["Maßstab", "straße", "École", "x×y÷zab", "abc-defgh", "naïve1naive", "HELLO", "hello", "hellо", "日本"]) for _ in range(200))) for k in range(40)]
    rows += [(None, "hello HELLO"), (1, None), (2, ""), *edge_texts()]
    found = spelling_variants.frequent_words(spelling_variants.damaged(spelling_variants.letter_runs(docs(spark, rows))))
    assert {r.word: r.n for r in found.collect()} == plain_words(rows)
    assert sum(plain_words(rows).values()) > 0


def test_variants_of_documents(spark, tmp_path):
    rng = random.Random(8)
    base = ["spelling", "variant", "grouping", "anagram", "hashing", "letters"]
    text = lambda: " ".join(w if rng.random() < 0.8 else w[: (k := rng.randrange(len(w)))] + rng.choice(["", "e", "é"]) + w[k + 1 :] for w in rng.choices(base, k=80))
    rows = [(k, text()) for k in range(60)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op12_spelling_variants"](spark, str(tmp_path))
    assert ordered(found.select("word", "form", "root", "n", "n_near", "form_n").collect()) == ordered(plain_forms(plain_words(rows)))


def test_no_words(spark):
    assert spelling_variants.spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_rests_are_hashes_of_shorter_words():
    for word in ("banana", "aaaaa", "ébéné", "x"):
        for letter in set(word):
            for place, *hashes in spelling_variants.rests(word, ord(letter)):
                assert tuple(hashes) == spelling_variants.whole_hash(word[:place] + word[place + 1 :])


# ---- op13 ----


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, label, 1, 2, "x") for i, label, v in rows], f"vec_id long, embedding array<{kind}>, label int, `a.b` int, rank int, raw string")


def plain_negatives(rows, positives=5, negatives=10):
    """Rows (id, label, vector) as whole numbers; anchors are ids divisible by 100."""
    ok = lambda i, label, v: i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    whole = lambda x: int(x) * 256 if abs(x) > 2**60 else math.floor(256 * x)
    own = {(i, label, tuple(map(whole, v))) for i, label, v in rows if ok(i, label, v)}
    out = []
    for i, label, v in own:
        if i % 100:
            continue
        scores = [(min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(1 << 63)), (1 << 63) - 1), j, m) for j, m, w in own if len(w) == len(v)]
        best = sorted((-s, j) for s, j, m in scores if m == label and j != i)[:positives]
        for less, j in best:
            found = sorted((-s, k) for s, k, m in scores if m != label and 30 * -less <= 100 * s <= 90 * -less)[:negatives]
            out += [(i, j, r, k, -less, -s) for r, (s, k) in enumerate(found, 1)]
    return out


def vector_rows(seed, n, d=6):
    rng = np.random.default_rng(seed)
    rows = [(int(k * 20), int(rng.integers(3)), (rng.integers(-4, 9, d) / 8).tolist()) for k in range(n)]
    # a third are one vector; ties everywhere, as components are eighths
    rows += [(10_001 + k, int(k % 3), [0.5] * d) for k in range(n // 2)]
    return rows


@pytest.mark.parametrize("use", [hard_negatives.Settings(), hard_negatives.Settings(tile=7, work=2000, block_bytes=300)])
def test_negatives_against_a_plain_version(spark, use):
    rows = vector_rows(use.tile, 120)
    found = hard_negatives.hard_negatives(vectors(spark, rows, "float"), F.col("vec_id") % 100 == 0, use)
    want = plain_negatives(rows)
    assert len(want) > 100
    assert ordered(found.collect()) == ordered(want)


def test_negatives_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (100, 1, [1.0, 2.0]), (101, 1, [1.0, 1.0]), (102, 2, [0.5, 0.6]), (103, 2, [0.5, 0.6]), (104, None, [1.0, 1.0]), (105, 1, None), (106, 1, [nan, 1.0]), (107, 2, [None, 1.0]),
        (108, 2, [inf, 1.0]), (None, 1, [1.0, 1.0]), (109, 2, [0.5]), (110, 2, [0.5, 0.5, 0.5]), (200, 1, []), (201, 1, []), (202, 2, []), (203, 3, [0.0, 0.0]), (300, 7, [1.0, 1.0]),
        (100, 1, [1.0, 2.0]), (103, 2, [0.5, 0.6]), (100, 2, [1.0, 2.0]), (100, 1, [-1.0, -2.0]), (-100, 1, [1.0, 1.5]), (-7, 2, [0.7, 0.7]),
    ]
    found = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 100 == 0)
    assert ordered(found.collect()) == ordered(plain_negatives(rows))
    assert hard_negatives.hard_negatives(vectors(spark, []), F.col("vec_id") % 100 == 0).collect() == []
    assert hard_negatives.hard_negatives(vectors(spark, rows[1:4]), F.col("vec_id") % 100 == 0).collect() == []


def test_large_components_are_exact(spark):
    rng = random.Random(13)
    rows = [(20 * k, k % 2, [rng.choice([1.0, 2.0**20 + 1, 2.0**22 + 1, 3.0**11, -(2.0**21), 2.0**30, 0.3]) for _ in range(4)]) for k in range(60)]
    rows += [(5001, 0, [1e200, -1e200, 1.0, 1e308]), (5002, 1, [1e18, 1.0, 1.0, 1.0])]
    found = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 100 == 0, hard_negatives.Settings(tile=16))
    assert ordered(found.collect()) == ordered(plain_negatives(rows))
