"""Spelling variants by anagram hashing.

1. Words are counted over all texts; counts are combined before the shuffle, so
   a frequent word is a few rows.
2. A word's anagram key is the sum of the fifth powers of its code points, modulo
   2^64. Words that differ by one letter have keys that differ by one letter's
   value (added or removed) or by the difference of two (exchanged). Taking each
   of its letters off a key gives its reduced keys; an exchange is two keys with a
   reduced key in common, an addition a key that is another's reduced key. So the
   join is one of keys on equality. A reduced key has at most as many keys as the
   alphabet has letters, and one more; groups of anagrams are one key.
3. Order of letters: words whose key has a neighbour are written without each
   place of the letter in question, as a 122-bit hash of what stays. Words with
   equal rests at equal places are exchanges, a rest that is a word is a removal.
   Such a group holds at most one word for each letter and place.
4. Exchanges aren't paired: a word's best is the first of its group, or the second
   where it is the first itself.
5. A word's form is its most frequent near word, if that is frequent enough. Forms
   get more frequent along a chain, so chains end; each round doubles the steps.

Edge cases: a null text has no words; a null id counts as the empty text before
the colon; repeated rows count again; ties of forms go to the smaller word; long
words cost a row for each place of a letter with a neighbour; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.llm.line_dedup import with_key_in
from surveyloom.llm.tables import table, written

RUN = "[A-Za-zÀ-ÿ]+"
#: Least code points and occurrences of a word, and how many times as frequent its form must be.
LETTERS, TIMES, FORM = 5, 3, 2
#: One run in so many loses a letter in the query.
DAMAGED = 97
POWER = 5
#: Two hashes of what stays of a word, modulo a prime.
PRIME, BASES = (1 << 61) - 1, (1_000_003, 998_244_353)
#: Most reduced keys that are broadcast.
MOST_HOT = 10_000


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def letter_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run) of all runs of letters, A-Z in lower case."""
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"({RUN})"), F.lit(1))
    return docs.select(F.col("doc_id").cast("long"), F.explode(runs).alias("run")).select("doc_id", lower_ascii(F.col("run")).alias("run"))


def damaged(runs: DataFrame) -> DataFrame:
    """(word): runs as they are, but one in ``DAMAGED`` loses a letter; which one follows from the document and the run."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return runs.select(F.when(h % DAMAGED == 0, shorter).otherwise(F.col("run")).alias("word"))


def frequent_words(words: DataFrame, letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """(word, n) of rows (word)."""
    counted = words.where(F.char_length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= times)


# ---- keys ----


def codes_of(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)


def keyed(words: DataFrame) -> DataFrame:
    """(word, n, key, letter, reduced): a row for each letter of a word."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(np.unique(codes := codes_of(w)), (codes**POWER).sum()) for w in batch.column(0).to_pylist()]
            sizes = [len(letters) for letters, _ in found]
            letters = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint64)
            key = np.repeat(np.array([k for _, k in found], np.uint64), sizes)
            row = np.repeat(np.arange(len(sizes)), sizes)
            own = batch.take(pa.array(row))
            signed = lambda x: pa.array(x.view(np.int64))
            yield pa.RecordBatch.from_arrays([*own.columns, signed(key), pa.array(letters.astype(np.int32)), signed(key - letters**POWER)], names=["word", "n", "key", "letter", "reduced"])

    return words.select("word", "n").mapInArrow(keys, "word string, n long, key long, letter int, reduced long")


def met_keys(rows: DataFrame) -> DataFrame:
    """(reduced, n) of the reduced keys by which keys meet; ``n`` counts the words that they are reduced from."""
    keys = rows.groupBy("reduced", "key").agg(F.count(F.lit(1)).alias("n"))
    # a key is met by itself where it is reduced by nothing
    whole = rows.select(F.col("key").alias("reduced")).distinct().select("reduced", F.lit(None).cast("long").alias("key"), F.lit(0).cast("long").alias("n"))
    met = keys.unionByName(whole).groupBy("reduced").agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("n"))
    return met.where((F.col("keys") > 1) & (F.col("n") > 0)).select("reduced", "n")


# ---- order of letters ----


def rests(word: str, letter: int) -> Iterator[tuple[int, int, int]]:
    """(place, hash, hash) of the word without each place of a letter."""
    codes = codes_of(word).tolist()
    at = [k for k, c in enumerate(codes) if c == letter]
    columns = []
    for base in BASES:
        # a polynomial in the base, the last letter having power 0
        before, powers = [0], [1]
        for c in codes:
            before.append((before[-1] * base + c) % PRIME)
            powers.append(powers[-1] * base % PRIME)
        n, all_ = len(codes), before[-1]
        columns.append([(before[k] * powers[n - k - 1] + all_ - before[k + 1] * powers[n - k - 1]) % PRIME for k in at])
    return zip(at, *columns, strict=True)


def whole_hash(word: str) -> tuple[int, ...]:
    out = []
    for base in BASES:
        h = 0
        for c in codes_of(word).tolist():
            h = (h * base + c) % PRIME
        out.append(h)
    return tuple(out)


REST = ["rest1", "rest2"]


def spelled_rests(rows: DataFrame) -> DataFrame:
    """(word, n, place, rest1, rest2) of rows (word, n, letter)."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, *x) for k, (w, c) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)) for x in rests(w, c)]
            row, place, one, two = (np.array(x, np.int64) for x in (zip(*found, strict=True) if found else ((), (), (), ())))
            own = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*own.columns[:2], pa.array(place.astype(np.int32)), pa.array(one), pa.array(two)], names=["word", "n", "place", *REST])

    return rows.select("word", "n", "letter").mapInArrow(spell, "word string, n long, place int, rest1 long, rest2 long")


def spelled_whole(words: DataFrame) -> DataFrame:
    """(word, n, rest1, rest2): the hash of the whole word."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.array([whole_hash(w) for w in batch.column(0).to_pylist()], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy())], names=["word", "n", *REST])

    return words.select("word", "n").mapInArrow(spell, "word string, n long, rest1 long, rest2 long")


#: The better of two near words is the smaller of these.
def merit(n: Column, word: Column) -> Column:
    return F.struct((-n).alias("less"), word.alias("word"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of a written table (word, n): how many words are one letter away, and the best as (less, word)."""
    rows = written(keyed(words), "anagram-keys")
    met = written(met_keys(rows), "met-keys")
    cut = written(spelled_rests(with_key_in(rows, met, ["reduced"], MOST_HOT)), "rests")
    own = Window.partitionBy(*REST, "place")
    order = own.orderBy("merit")
    group = cut.select("*", merit(F.col("n"), F.col("word")).alias("merit")).select(
        "word", F.count(F.lit(1)).over(own).alias("size"), F.row_number().over(order).alias("rank"), F.first("merit").over(order).alias("first"), F.lead("merit").over(order).alias("next")
    ).where("size > 1")
    exchanged = group.select("word", (F.col("size") - 1).alias("n_near"), F.when(F.col("rank") == 1, F.col("next")).otherwise(F.col("first")).alias("best"))
    # the same rest at neighbouring places of one letter is one removal
    longer = cut.groupBy("word", "n", *REST).agg(F.lit(1).alias("one"))
    pairs = longer.select(F.col("word").alias("long"), F.col("n").alias("n_long"), *REST).join(spelled_whole(words).withColumnsRenamed({"word": "short", "n": "n_short"}), REST)
    removed = pairs.select("long", F.lit(1).cast("long"), merit(F.col("n_short"), F.col("short"))).toDF("word", "n_near", "best")
    added = pairs.select("short", F.lit(1).cast("long"), merit(F.col("n_long"), F.col("long"))).toDF("word", "n_near", "best")
    return exchanged.unionByName(removed).unionByName(added).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a written table (word, form): the end of each word's chain."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = written(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(words: DataFrame, form: int = FORM) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of rows (word, n) with distinct words."""
    words = written(words, "words")
    near = near_words(words).select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.less")).alias("best_n"))
    enough = F.col("best_n") >= form * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")
    )
    found = written(found, "forms")
    ends = roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(frequent_words(damaged(letter_runs(table(spark, sf_dir, "documents")))))


# ---- DuckDB ----


def crc_table() -> list[int]:
    """The 256 remainders of the reversed polynomial 0xEDB88320."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTES = "list_transform(range(length(code) // 2), lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT))"
OP12_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{RUN}')) AS run FROM documents) GROUP BY ALL
), coded AS (SELECT *, hex(encode(concat(CAST(doc_id AS VARCHAR), ':', run))) AS code FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce({_BYTES}, lambda c, b: xor(c >> 8, {crc_table()}[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM coded
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {DAMAGED} = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {LETTERS} GROUP BY word HAVING sum(n) >= {TIMES}
), cut AS (
  SELECT word, n, place, concat(substr(word, 1, place), substr(word, place + 2)) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS place FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {FORM} * w.n THEN other END AS form, CASE WHEN other_n >= {FORM} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS root, 0 AS steps FROM forms UNION ALL SELECT c.word, f.form, steps + 1 FROM chains c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN (SELECT word, arg_max(root, steps) AS root FROM chains GROUP BY word) USING (word)
"""
