"""Packed token-id matrices: best-fit-decreasing with a segment tree.

Documents are tokenised where they are read and packed there, a window of
``WINDOW`` ids at a time, so no ids are shuffled. Documents longer than a row
are cut into pieces; (doc_id, piece, start, length) restore them without
loss. A segment tree over the rows' free space finds the tightest row for a
piece in logarithmic time.

Each output row is one matrix row: ``ids`` holds ``width`` little-endian
unsigned 32-bit ids padded by ``PAD``; ``cu_seqlens`` the cumulative segment
lengths from 0; ``position_resets`` the places where positions start again
from 0 (the segments' starts, and that of the padding, if any).
``write_matrices`` stores such rows below a path, ``read_matrices`` reads and
checks them: the stored form is Parquet with a binary column of ids, so a
training job maps a row's bytes as they are.

Edge cases: a null text is an empty document and holds only the end mark;
repeated rows are documents of their own; empty tables give empty results;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.tables import shared_dir, table
from surveyloom.llm.token_ids import cut, document_ids

WIDTH, PAD = 2048, 50256
#: Ids packed together: about 4,000 rows of a matrix.
WINDOW = 1 << 23

SCHEMA = (
    "row_id long, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, position_resets array<int>,"
    " doc_ids array<long>, pieces array<int>, starts array<long>"
)


class RoomTree:
    """Segment tree over amounts of free space; a node counts the open rows below it."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, amount: int, by: int) -> None:
        k = self.leaves + amount
        while k:
            self.count[k] += by
            k >>= 1

    def put(self, amount: int, row: int) -> None:
        self.rows[amount].append(row)
        self._add(amount, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(free space, row) of the row with the least free space of at least ``least``."""
        k = self.leaves + least
        while not self.count[k]:
            # up while this is a right child, then over to the right neighbour
            while k & 1:
                k >>= 1
            if not k:
                return None
            k += 1
            if k == 1:
                return None
        while k < self.leaves:
            k = 2 * k if self.count[2 * k] else 2 * k + 1
        amount = k - self.leaves
        self._add(amount, -1)
        return amount, self.rows[amount].pop()


def best_fit_decreasing(sizes: list[int], width: int) -> list[list[int]]:
    """Rows of item numbers; no row's sizes add up to more than ``width``."""
    tree, rows = RoomTree(width), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            found = width, len(rows)
            rows.append([])
        rows[found[1]].append(i)
        if found[0] > sizes[i]:
            tree.put(found[0] - sizes[i], found[1])
    return rows


def position_ids(cu_seqlens: list[int], width: int) -> np.ndarray:
    """Positions of a matrix row, from 0 in each segment and in the padding."""
    edges = np.unique([*cu_seqlens, width])
    at = np.arange(width)
    return at - edges[np.searchsorted(edges, at, "right") - 1]


def packed_matrices(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = TaskContext.get().partitionId() << 40
        window: list[tuple[int | None, int, int, np.ndarray]] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal row_id
            rows = []
            for items in best_fit_decreasing([len(x[3]) for x in window], width):
                own = [window[i] for i in items]
                cu = np.concatenate([[0], np.cumsum([len(x[3]) for x in own])]).astype(int).tolist()
                ids = np.full(width, PAD, "<u4")
                ids[: cu[-1]] = np.concatenate([x[3] for x in own])
                resets = cu if cu[-1] < width else cu[:-1]
                rows.append((row_id, cu[-1], len(own), ids.tobytes(), cu, resets, [x[0] for x in own], [x[1] for x in own], [x[2] for x in own]))
                row_id += 1
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), *[pa.list_(t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64())]]
            names = [x.strip().split()[0] for x in SCHEMA.split(",")]
            for k in range(0, len(rows), 1024):
                columns = zip(*rows[k : k + 1024], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = document_ids(text.as_py())
                window += [(key, k, a, ids[a : a + size]) for k, (a, size) in enumerate(cut(len(ids), width))]
                held += len(ids)
                if held >= WINDOW:
                    yield from out()
                    window, held = [], 0
        if window:
            yield from out()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(packed, SCHEMA)


def write_matrices(docs: DataFrame, path: str, width: int = WIDTH) -> None:
    """Write the packed matrix rows of all documents below ``path``."""
    packed_matrices(docs, width).write.option("compression", "zstd").parquet(path)


def read_matrices(spark: SparkSession, path: str, width: int = WIDTH) -> DataFrame:
    """The rows below ``path``; one that isn't whole (ids of another width, lengths that don't add up) is an error."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    ends = F.element_at("cu_seqlens", -1)
    whole = (F.octet_length("ids") == 4 * width) & (ends == F.col("n_tokens")) & (ends <= width) & (F.size("cu_seqlens") == F.col("n_segments") + 1) & (F.size("doc_ids") == F.col("n_segments"))
    checked = F.when(whole, F.col("ids")).otherwise(F.raise_error(F.concat(F.lit("matrix row isn't whole: "), F.col("row_id").cast("string"))))
    return rows.withColumn("ids", checked)


def op8_packed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/matrices-{uuid.uuid4().hex}"
    write_matrices(table(spark, sf_dir, "documents"), path)
    return read_matrices(spark, path)
