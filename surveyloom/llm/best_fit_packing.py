"""Hierarchical residual packing of documents into sequences.

1. Each document's ids are cut into pieces of at most the sequence length.
2. Pieces are dealt evenly to groups; each group packs its pieces best-fit in
   decreasing order. Sequences that are nearly full are done.
3. The underfull ones become items. A tree of groups packs the items of its
   children best-fit again, level by level, up to one root.

A best-fit group leaves at most one sequence that is half empty or more, so
two children can save at most one sequence each time they meet. What a group
hands to its parent is therefore limited to that one and to the ``HOSTS``
roomiest others that could take it in; what isn't handed on is final as it
is. No piece is ever dropped or cut further.

Edge cases: a null text is an empty document and holds only the end mark;
repeated rows are documents of their own; empty tables give empty results;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.tables import table, written
from surveyloom.llm.token_ids import crc, cut, document_ids

SEQUENCE = 1024
#: Ids a sequence may lack and still be done; pieces a group packs; children a group merges; roomy sequences it hands on.
SLACK, GROUP, FAN_IN, HOSTS = 16, 32_768, 8, 256

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, width: int = SEQUENCE) -> DataFrame:
    """One row per piece. ``uid`` numbers the pieces; the rows must be written before they are read twice."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        names = [x.split()[0] for x in PIECES.split(", ")]
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = document_ids(text.as_py())
                for k, (start, size) in enumerate(cut(len(ids), width)):
                    rows.append((uid, key, k, start, size, crc(ids[start : start + size])))
                    uid += 1
            if rows:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES)


def best_fit(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, fill of that bin) of each item, best-fit decreasing.

    Open bins are kept by what they have left; a bit set of the amounts in use gives the tightest in one step.
    """
    n = len(sizes)
    bins, offsets, fills = np.zeros(n, np.int64), np.zeros(n, np.int64), []
    left: list[list[int]] = [[] for _ in range(room + 1)]
    used = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        if fit := used >> size:
            amount = size + (fit & -fit).bit_length() - 1
            b = left[amount].pop()
            if not left[amount]:
                used ^= 1 << amount
        else:
            b, amount = len(fills), room
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        if rest := amount - size:
            left[rest].append(b)
            used |= 1 << rest
    return bins, offsets, np.asarray(fills, np.int64)[bins] if n else bins


def handed_on(fill: np.ndarray, room: int) -> np.ndarray:
    """Which bins go to the parent: those half empty or more, and the roomiest others."""
    on = fill <= room // 2
    others = np.flatnonzero(~on & (fill < room - SLACK))
    on[others[np.argsort(fill[others], kind="stable")[:HOSTS]]] = True
    return on


PLACED = "item long, bin long, offset long, fill long, open boolean"


def packer(room: int, level: int):
    """A group function: packs the group's items; bin ids tell the level, the group and the bin."""

    def pack(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("item", kind="stable")
        b, offset, fill = best_fit(items["size"].to_numpy(), room)
        of_bin = np.zeros(b.max(initial=-1) + 1, np.int64)
        of_bin[b] = fill
        base = (level << 58) | (int(key[0]) << 24)
        return pd.DataFrame({"item": items["item"].to_numpy(), "bin": base + b, "offset": offset, "fill": fill, "open": handed_on(of_bin, room)[b]})

    return pack


def pack_items(items: DataFrame, n_items: int, room: int = SEQUENCE) -> DataFrame:
    """(item, bin, offset) of items (item long, size long), each size from 1 to ``room``.

    ``items`` is read several times, so it should be a written table.
    """
    n = max(1, -(-n_items // GROUP))
    level = 0
    group = F.pmod(F.xxhash64("item"), F.lit(n)).alias("g")
    first = written(items.select(group, "item", "size").groupBy("g").applyInPandas(packer(room, level), PLACED), "packed")
    moved = None
    now = first
    while n > 1:
        n = -(-n // FAN_IN)
        level += 1
        # a bin's first item stands at offset 0, so these are the open bins, each once
        of_child = F.shiftright(F.col("bin").bitwiseAND((1 << 58) - 1), 24)
        up = now.where("open AND offset = 0").select((of_child / FAN_IN).cast("long").alias("g"), F.col("bin").alias("item"), F.col("fill").alias("size"))
        now = written(up.groupBy("g").applyInPandas(packer(room, level), PLACED), "merged")
        step = now.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("offset").alias("add"))
        if moved is None:
            moved = step
        else:
            later = step.select(F.col("bin").alias("to"), F.col("to").alias("to2"), F.col("add").alias("add2"))
            moved = moved.join(later, "to", "left").select("bin", F.coalesce("to2", "to").alias("to"), (F.col("add") + F.coalesce("add2", F.lit(0))).alias("add"))
    if moved is None:
        return first.select("item", "bin", "offset")
    return first.join(written(moved, "moved"), "bin", "left").select(
        "item", F.coalesce("to", "bin").alias("bin"), (F.col("offset") + F.coalesce("add", F.lit(0))).alias("offset")
    )


def best_fit_packing(docs: DataFrame, width: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``width`` ids."""
    pieces = written(token_pieces(docs, width), "pieces")
    small = pieces.where(F.col("length") < width).select(F.col("uid").alias("item"), F.col("length").alias("size"))
    placed = pack_items(small, small.count(), width).withColumnRenamed("item", "uid")
    # a piece as long as a sequence is a sequence: negative numbers
    whole = pieces.where(F.col("length") == width).select("*", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < width).join(placed, "uid").withColumnRenamed("bin", "sequence_id")
    return rest.select(whole.columns).unionByName(whole).drop("uid")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))
