"""Hard-negative mining by blocked dense products.

1. Rows are checked and their components made integers in one pass, into a
   written table of distinct rows (id, label, vector).
2. Anchors are dealt into blocks of about ``Settings.block_bytes``, by a hash of
   the row; none is twice as large, unless it is a single row. One block at a time
   is broadcast; their number grows with the anchors.
3. First pass of a block: tasks multiply tiles of candidates with tiles of anchors
   of the same label in float64, which is exact below 2^53, and keep a running top
   5 for each anchor. The tasks' tops are merged by a ranked window, which itself
   is cut before its shuffle.
4. The positives' scores give score windows; in the second pass each task keeps a
   running top 10 for each anchor and positive, merged in the same way.

A tile's new entries are first cut by the score that an entry needs to get into
the top so far, so ties and copies are never left out: those at that score stay
until ids decide. Rows whose components are so large that a product could reach
2^53 are multiplied with Python's integers instead; scores beyond a long count as
the largest or smallest long.

Edge cases: rows with a null id, label or vector or a null or non-finite component
take no part; empty vectors do, with score 0; vectors of different lengths don't
meet; rows equal in id, label and vector are one row; rows with the anchor's own id
aren't its positives, rows with equal ids but other vectors or labels are rows of
their own, as anchors too; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.llm.tables import table, written

LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: A row in the broadcast, about.
ROW_BYTES = "length * 8 + 64"


class Settings(NamedTuple):
    positives: int = 5
    negatives: int = 10
    #: Negatives score at least and at most so many hundredths of the positive's score.
    low: int = 30
    high: int = 90
    #: What a component is multiplied with before it is cut to an integer.
    scale: int = 256
    #: Bytes of vectors of an anchor block, rows of a tile, products that a task does.
    block_bytes: int = 1 << 24
    tile: int = 1024
    work: int = 1 << 28


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, length, raw): rows that take part, their components as whole numbers in float64."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, lengths, raws = [], [], []
            for k, values in enumerate(batch.column(2)):
                if values.values.null_count:
                    continue
                x = values.values.to_numpy(zero_copy_only=False).astype("<f8")
                if np.isfinite(x).all():
                    with np.errstate(over="ignore"):
                        x = np.clip(np.floor(x * scale), -np.finfo("<f8").max, np.finfo("<f8").max)
                    kept.append(k)
                    lengths.append(len(x))
                    raws.append((x + 0.0).tobytes())
            own = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(lengths, pa.int32()), pa.array(raws, pa.binary())], names=["vec_id", "label", "length", "raw"])

    own = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>"))
    return own.dropna("any").mapInArrow(whole, "vec_id long, label string, length int, raw binary")


# ---- products ----


class Rows(NamedTuple):
    """Rows of one length."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray

    def part(self, at) -> Rows:
        return Rows(self.ids[at], self.labels[at], self.x[at])

    def large(self) -> np.ndarray:
        """Rows whose products with rows that aren't large could reach 2^53."""
        d = self.x.shape[1]
        return np.abs(self.x).max(1, initial=0.0) >= math.isqrt((1 << 53) // max(d, 1))


def rows_of(ids: list, labels: list, lengths: list, raws: list) -> dict[int, Rows]:
    """Rows by length, by ascending id."""
    out = {}
    lengths = np.array(lengths, np.int64)
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        own = np.array([ids[k] for k in at], np.int64)
        order = np.argsort(own, kind="stable")
        x = np.frombuffer(b"".join(raws[k] for k in at), "<f8").reshape(len(at), n)
        out[n] = Rows(own[order], np.array([labels[k] for k in at], object)[order], x[order])
    return out


def exact_product(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Python's integers, cut to the range of a long."""
    whole = lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
    out = np.clip(whole(a) @ whole(c).T, LEAST, MOST) if a.shape[1] else np.zeros((len(a), len(c)))
    return out.astype(np.int64)


def products(a: Rows, c: Rows, tile: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in a, places in c, scores) tile by tile."""
    a_large, c_large = a.large(), c.large()
    for a_side in (False, True):
        for c_side in (False, True):
            ours, theirs = np.flatnonzero(a_large == a_side), np.flatnonzero(c_large == c_side)
            for i in range(0, len(ours), tile):
                for j in range(0, len(theirs), tile):
                    p, q = ours[i : i + tile], theirs[j : j + tile]
                    yield p, q, exact_product(a.x[p], c.x[q]) if a_side or c_side else (a.x[p] @ c.x[q].T).astype(np.int64)


class Tops:
    """The best ``k`` (score, id) of each slot: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.slot, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: Score that an entry needs.
        self.least = np.full(slots, LEAST, np.int64)

    def add(self, slots: np.ndarray, allowed: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rows of ``scores`` belong to ``slots``, columns to ``ids``."""
        allowed = allowed & (scores >= self.least[slots][:, None])
        if not allowed.any():
            return
        if scores.shape[1] > self.k:
            # what is below a row's own k-th best can't stay
            own = np.where(allowed, scores, LEAST)
            allowed &= scores >= np.partition(own, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k][:, None]
        at, column = np.nonzero(allowed)
        slot = np.concatenate([self.slot, slots[at]])
        score = np.concatenate([self.score, scores[at, column]])
        key = np.concatenate([self.id, ids[column]])
        # ~x turns the order round without leaving the range
        order = np.lexsort((key, ~score, slot))
        slot, score, key = slot[order], score[order], key[order]
        starts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        rank = np.arange(len(slot)) - np.repeat(starts, np.diff(np.append(starts, len(slot))))
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], key[keep]
        full = rank == self.k - 1
        self.least[slot[full]] = score[full]

    def batch(self, names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.slot), pa.array(self.id), pa.array(self.score)], names=names)


def candidates_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Rows]]:
    for batch in batches:
        yield from rows_of(*[c.to_pylist() for c in batch.columns]).items()


class Block(NamedTuple):
    """Anchors: their numbers in the block, and their rows, by length."""

    numbers: dict[int, np.ndarray]
    rows: dict[int, Rows]


def block_of(found: pa.Table) -> Block:
    numbers = np.array(found.column("number").to_pylist(), np.int64)
    lengths = np.array(found.column("length").to_pylist(), np.int64)
    # ``rows_of`` sorts by id, so numbers go the same way
    ids = np.array(found.column("vec_id").to_pylist(), np.int64)
    own = {n: (at := np.flatnonzero(lengths == n))[np.argsort(ids[at], kind="stable")] for n in np.unique(lengths).tolist()}
    rows = rows_of(*[found.column(c).to_pylist() for c in ("vec_id", "label", "length", "raw")])
    return Block({n: numbers[at] for n, at in own.items()}, rows)


def best_positives(block: Block, size: int, batches: Iterator[pa.RecordBatch], use: Settings) -> Tops:
    """Slots are the anchors' numbers."""
    tops = Tops(size, use.positives)
    for n, own in candidates_of(batches):
        if n not in block.rows:
            continue
        anchors, numbers = block.rows[n], block.numbers[n]
        for label in set(own.labels.tolist()):
            a, c = np.flatnonzero(anchors.labels == label), np.flatnonzero(own.labels == label)
            if len(a):
                for p, q, scores in products(anchors.part(a), own.part(c), use.tile):
                    tops.add(numbers[a[p]], anchors.ids[a[p]][:, None] != own.ids[c[q]][None, :], scores, own.ids[c[q]])
    return tops


def best_negatives(block: Block, low: np.ndarray, high: np.ndarray, batches: Iterator[pa.RecordBatch], use: Settings) -> Tops:
    """``low`` and ``high`` hold the score window of each anchor and positive; slots are places in them, row by row."""
    tops = Tops(low.size, use.negatives)
    width = low.shape[1]
    wanted = (low <= high).any(1)
    for n, own in candidates_of(batches):
        if n not in block.rows:
            continue
        anchors, numbers = block.rows[n], block.numbers[n]
        some = np.flatnonzero(wanted[numbers])
        if not len(some):
            continue
        names, label = np.unique(np.concatenate([anchors.labels[some], own.labels]).astype(str), return_inverse=True)
        ours, theirs = label[: len(some)], label[len(some) :]
        for p, q, scores in products(anchors.part(some), own, use.tile):
            number = numbers[some[p]]
            other = ours[p][:, None] != theirs[q][None, :]
            for j in range(width):
                inside = other & (scores >= low[number, j][:, None]) & (scores <= high[number, j][:, None])
                tops.add(number * width + j, inside, scores, own.ids[q])
    return tops


# ---- jobs ----


def anchor_blocks(anchors: DataFrame, most: int) -> tuple[DataFrame, int]:
    """A written table of anchors with their ``block``, and the number of blocks."""
    n, size = anchors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.expr(ROW_BYTES)), F.lit(0))).first()
    blocks = math.ceil(size / most)
    while True:
        dealt = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "raw"), F.lit(max(1, blocks))).cast("int"))
        largest = dealt.groupBy("block").agg(F.sum(F.expr(ROW_BYTES)).alias("size"), F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.max("size")).first()[0]
        if blocks <= 1 or (largest or 0) <= 2 * most or blocks > 4 * n:
            return written(dealt, "anchors"), blocks
        blocks *= 2


def ranked(tops: DataFrame, most: int) -> DataFrame:
    """The first rows (slot, id, score) of each slot, with their rank."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


TOPS = "slot long, id long, score long"


def mined_block(block: pa.Table, candidates: DataFrame, use: Settings) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of one block of anchors."""
    spark = candidates.sparkSession
    size = block.num_rows
    anchors = spark.sparkContext.broadcast(block_of(block))
    first = candidates.mapInArrow(lambda batches: iter([best_positives(anchors.value, size, batches, use).batch(["slot", "id", "score"])]), TOPS)
    positives = written(ranked(first, use.positives), "positives")
    # no more than so many for each anchor of the block
    found = positives.toArrow().to_pydict()
    low, high = np.ones((size, use.positives), np.int64), np.zeros((size, use.positives), np.int64)
    for slot, rank, score in zip(found["slot"], found["rank"], found["score"], strict=True):
        low[slot, rank - 1], high[slot, rank - 1] = -(-use.low * score // 100), use.high * score // 100
    windows = spark.sparkContext.broadcast((low, high))
    second = candidates.mapInArrow(lambda batches: iter([best_negatives(anchors.value, *windows.value, batches, use).batch(["slot", "id", "score"])]), TOPS)
    negatives = ranked(second, use.negatives).select("slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = spark.createDataFrame(block.select(["number", "vec_id"])).withColumnsRenamed({"vec_id": "anchor_id", "number": "slot"})
    own = positives.join(ids, "slot").select((F.col("slot") * use.positives + F.col("rank") - 1).alias("slot"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = own.join(negatives, "slot").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    out = written(out, "negatives")
    anchors.unpersist()
    windows.unpersist()
    return out


def hard_negatives(vectors: DataFrame, anchor: Column, use: Settings = Settings()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchor`` tells which rows (by vec_id, label) are anchors."""
    rows = written(integer_vectors(vectors, use.scale).dropDuplicates(["vec_id", "label", "length", "raw"]), "integer-vectors")
    anchors, blocks = anchor_blocks(rows.where(anchor), use.block_bytes)
    n, longest, n_anchors = *rows.agg(F.count(F.lit(1)), F.coalesce(F.max("length"), F.lit(0))).first(), anchors.count()
    # tasks by work, of no more than some 2^18 rows unless there are few
    tasks = min(math.ceil(n * math.ceil(n_anchors / max(1, blocks)) * longest / use.work), max(64, n >> 18))
    candidates = rows.repartition(max(1, tasks), "vec_id")
    out = rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for k in range(blocks):
        own = anchors.where(F.col("block") == k).drop("block").toArrow()
        if own.num_rows:
            out = out.unionByName(mined_block(own.append_column("number", pa.array(range(own.num_rows), pa.int64())), candidates, use))
    return out


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, a.v AS anchor, c.vec_id AS id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM rows a JOIN rows c ON len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, anchor, id AS positive_id, score AS positive_score FROM scores WHERE same AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor ORDER BY score DESC, id) <= 5
), negatives AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.anchor, positive_id, positive_score ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND p.anchor = s.anchor
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""
