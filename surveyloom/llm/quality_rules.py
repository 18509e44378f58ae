"""Quality rules with compression bands.

Base counts (words, symbols, repeated lines, repeated three-word windows) and
zstandard ratios of the whole document and of its fixed 4096-byte chunks, the
shorter last one included. A ratio above the limit for the length means
repetitive text, one below the lower limit means incompressible text. A
document goes if its own ratio is beyond a limit, or if the chunks that are
hold half of its bytes.

The limits are a parameter (``Limits``); those given are fixed values for prose in
a few European languages. ``fit_limits`` derives them for another corpus from all
documents that are labelled good, with a stated margin.

Edge cases: a null text counts as having no words (``base_failed``); empty
tables give empty results; repeated rows are judged row by row; only the id
and text columns are read, so other columns may have any names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.blocks import lean_batches, texts
from surveyloom.llm.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")

MIN_WORDS = 50
CHUNK_BYTES = 4096
ZSTD_LEVEL = 3
SHORTEST = 512


class Limits(NamedTuple):
    #: Highest plausible ratio of a text under ``SHORTEST`` bytes, and what each doubling adds: longer prose has more to refer back to.
    repetitive_base: float = 2.0
    repetitive_step: float = 0.1
    #: (bytes below this, lowest plausible ratio)
    incompressible: tuple[tuple[float, float], ...] = ((SHORTEST, 1.05), (2048, 1.2), (math.inf, 1.35))
    #: Limits of a whole chunk; a shorter one has those of a text of its length.
    chunk_low: float = 1.35
    chunk_high: float = 2.4
    #: Share of a document's bytes in chunks beyond their limits that rejects it.
    chunk_share: float = 0.5

    def highest(self, n_bytes: int) -> float:
        return self.repetitive_base + self.repetitive_step * doublings(n_bytes)

    def lowest(self, n_bytes: int) -> float:
        return next(x for n, x in self.incompressible if n_bytes < n)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, zstd_ratio double, bad_chunks long, n_chunks long"
)


def repeated_words(words: list[str]) -> int:
    """Words covered by a three-word window that is found at least twice."""
    if len(words) < 4:
        return 0
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(a):
        return 0
    _, pair = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)
    _, triple, times = np.unique(pair[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    again = times[triple] > 1
    hit = np.zeros(len(a), bool)
    for k in range(3):
        hit[k : k + len(again)] |= again
    return int(hit.sum())


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


def doublings(n_bytes: int) -> int:
    """How often a text of ``SHORTEST`` bytes doubles up to this length."""
    return max(0, math.ceil(math.log2(max(n_bytes, 1) / SHORTEST)))


def compression(raw: bytes, squeeze, limits: Limits = Limits()) -> tuple[bool, float, int, int]:
    """(within the bands, ratio, chunks beyond a limit, chunks)."""
    if not raw:
        return False, 0.0, 0, 0
    ratio = len(raw) / len(squeeze(raw))
    good = limits.lowest(len(raw)) <= ratio <= limits.highest(len(raw))
    if len(raw) < CHUNK_BYTES:
        return good, ratio, int(not good), 1
    bad = bad_bytes = 0
    for at in range(0, len(raw), CHUNK_BYTES):
        chunk = raw[at : at + CHUNK_BYTES]
        n = len(chunk)
        low, high = (limits.chunk_low, limits.chunk_high) if n == CHUNK_BYTES else (limits.lowest(n), limits.highest(n))
        if not low <= n / len(squeeze(chunk)) <= high:
            bad, bad_bytes = bad + 1, bad_bytes + n
    return good and bad_bytes < limits.chunk_share * len(raw), ratio, bad, -(-len(raw) // CHUNK_BYTES)


def judge(text: str | None, squeeze, limits: Limits = Limits()) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    n, chars, repeat = len(words), sum(map(len, words)), repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > 50 * n
    good, ratio, bad, chunks = compression(text.encode("utf-8"), squeeze, limits)
    return n, chars, len(SYMBOL.findall(text)), duplicate_lines(text), repeat, failed, not failed and good, ratio, bad, chunks


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Judge every document's whole text: one row per input row, no shuffle."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress
        names = [x.strip().split()[0] for x in SCHEMA.split(",")]
        for batch in batches:
            if batch.num_rows:
                rows = [judge(t.as_py(), squeeze, limits) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, zip(*rows, strict=True))], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean_batches(judged), SCHEMA)


def fit_limits(docs: DataFrame, good: DataFrame, margin: float = 0.02, step: float = Limits().repetitive_step) -> Limits:
    """Limits that all documents labelled good keep, with a relative margin; ``good`` has their ``doc_id``.

    All of these documents are measured, and two numbers for each doubling of the length are collected. Bounds that no
    good document speaks to keep their given values.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress
        for batch in batches:
            rows = []
            for raw in filter(None, texts(batch.column(0))):
                rows.append((len(raw), False, len(raw) / len(squeeze(raw))))
                rows += [(CHUNK_BYTES, True, CHUNK_BYTES / len(squeeze(raw[k : k + CHUNK_BYTES]))) for k in range(0, len(raw) - CHUNK_BYTES + 1, CHUNK_BYTES)]
            if rows:
                n, chunk, ratio = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(chunk), pa.array(ratio)], names=["n", "chunk", "ratio"])

    known = docs.join(good.select("doc_id").distinct(), "doc_id", "left_semi").select("text")
    found = known.mapInArrow(lean_batches(measured), "n long, chunk boolean, ratio double")
    given = Limits()
    size = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / SHORTEST))).cast("int")
    bound = F.coalesce(*[F.when(F.col("n") < n, k) for k, (n, _) in enumerate(given.incompressible[:-1])], F.lit(len(given.incompressible) - 1))
    rows = found.groupBy("chunk", size.alias("size"), bound.alias("bound")).agg(F.min("ratio").alias("low"), F.max("ratio").alias("high")).collect()
    whole, chunks = [r for r in rows if not r.chunk], [r for r in rows if r.chunk]
    lows = [min((r.low * (1 - margin) for r in whole if r.bound == k), default=x) for k, (_, x) in enumerate(given.incompressible)]
    return given._replace(
        repetitive_base=max((r.high * (1 + margin) - step * r["size"] for r in whole), default=given.repetitive_base), repetitive_step=step,
        incompressible=tuple((n, x) for (n, _), x in zip(given.incompressible, lows, strict=True)),
        chunk_low=min((r.low * (1 - margin) for r in chunks), default=given.chunk_low), chunk_high=max((r.high * (1 + margin) for r in chunks), default=given.chunk_high),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text passes the rules."""
    at = docs.columns.index("text")

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress
        for batch in batches:
            yield batch.filter(pa.array([judge(t.as_py(), squeeze, limits)[6] for t in batch.column(at)], pa.bool_()))

    # inside, columns go by numbers, so any names will do
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(lean_batches(good), plain.schema).toDF(*docs.columns)
