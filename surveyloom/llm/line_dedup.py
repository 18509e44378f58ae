"""Line dedup: lines that many documents share are dropped from all of them.

1. Texts are split at ``\\n``. A line's key is the line without white space
   (``[\\x20\\x09-\\x0D]``) at its ends, A-Z in lower case. Lines are exploded once
   into a written table of the key's 128-bit hash, the document and the place;
   no text goes there.
2. Distinct documents are counted for each hash: first distinct pairs, spread by
   hash and document, then partial counts. A line that a third of all documents
   hold is a few rows for each task by then.
3. Hashes at the threshold or above meet the lines again. Those that hold more
   than one part in ``MOST_HOT`` of all places are broadcast, as there can be no
   more than ``MOST_HOT`` of them; the others are joined by hash.
4. Dropped places are gathered for each document. The texts move once, to meet
   them, and the lines left are put together by place.

Documents are rows. Rows with the same id are one document in the count (null
is an id like any other there), and each of them is returned. Edge cases: a
null or empty text is one empty line; empty keys are never dropped unless
``characters`` is 0; a document may lose all its lines and is then empty; a line
found twice in a text counts once and goes twice; texts are read whole; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.tables import table, written

#: Documents that must hold a line for it to go, and the least code points of its key.
DOCUMENTS, CHARACTERS = 10, 1
#: Most keys that are broadcast (16 bytes each).
MOST_HOT = 10_000
WHITE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line as it is compared."""
    bare = F.btrim(line, F.lit(WHITE))
    # lower() also changes other letters, so it serves texts of ASCII only
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def digest(prefix: str, *columns: Column) -> list[Column]:
    """128 bits of some columns, as two long columns."""
    return [F.xxhash64(*columns).alias(f"{prefix}1"), F.xxhash64(F.lit(1), *columns).alias(f"{prefix}2")]


LINE, DOC = ["line1", "line2"], ["doc1", "doc2"]


def numbered_texts(docs: DataFrame) -> DataFrame:
    """(doc1, doc2, doc_id, lines): each row's digest and the lines of its text."""
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return own.select(*digest("doc", F.col("doc_id"), F.col("text")), "doc_id", F.split("text", "\n", -1).alias("lines"))


def hashed_lines(texts: DataFrame, characters: int) -> DataFrame:
    """(line1, line2, doc1, doc2, doc_id, place, n_lines) of all lines whose key is long enough."""
    lines = texts.select(*DOC, "doc_id", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("place", "line")).withColumn("key", line_key(F.col("line")))
    return lines.where(F.char_length("key") >= characters).select(*digest("line", F.col("key")), *DOC, "doc_id", "place", "n_lines")


def common_lines(lines: DataFrame, documents: int) -> DataFrame:
    """(line1, line2, n) of the lines found in at least so many documents; ``n`` counts places."""
    pairs = lines.groupBy(*LINE, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    found = pairs.groupBy(*LINE).agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("n"))
    return found.where(F.col("documents") >= documents).select(*LINE, "n")


def with_key_in(rows: DataFrame, keys: DataFrame, on: list[str], most: int) -> DataFrame:
    """The rows whose key is in ``keys``, a written table of single keys with the number ``n`` of their rows.

    Keys that hold more than one part in ``most`` of the rows found are broadcast; no more than ``most`` keys can.
    """
    share = (keys.agg(F.sum("n")).first()[0] or 0) // most
    hot, others = keys.where(F.col("n") > share).select(*on), keys.where(F.col("n") <= share).select(*on)
    return rows.join(F.broadcast(hot), on, "left_semi").unionByName(rows.join(others, on, "left_semi"))


def drop_common_lines(docs: DataFrame, documents: int = DOCUMENTS, characters: int = CHARACTERS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of rows (doc_id, text): texts without the lines that many documents share."""
    texts = numbered_texts(docs)
    lines = written(hashed_lines(texts, characters), "lines")
    common = written(common_lines(lines, documents), "common-lines")
    found = with_key_in(lines, common, LINE, MOST_HOT)
    gone = found.groupBy(*DOC).agg(F.collect_set("place").alias("gone"), F.first("n_lines").alias("n_lines"))
    gone = gone.select(*DOC, F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), "gone").alias("left"))
    # lines travel as an array: the text would be split again for each line that stays
    both = texts.join(gone, DOC, "left")
    left = F.when(F.col("left").isNull(), F.col("lines")).otherwise(F.transform("left", lambda k: F.get("lines", k)))
    n_dropped = F.when(F.col("left").isNull(), 0).otherwise(F.size("lines") - F.size("left"))
    return both.select(
        "doc_id", F.array_join(left, "\n").alias("text"), F.size("lines").cast("long").alias("n_lines"),
        n_dropped.cast("long").alias("n_dropped"),
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_common_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP11_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
places AS (SELECT r, doc_id, unnest(range(len(lines))) AS place, unnest(lines) AS line FROM texts),
keyed AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM places),
common AS (SELECT key FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE key <> '') GROUP BY key HAVING count(*) >= {DOCUMENTS})
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (c.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key GROUP BY r
"""
