"""Embedding near-dedup by a forest of random-projection trees.

1. Equal vectors of one label are one class with a count; from here on only
   classes count, so a large group of copies is one row.
2. Trees: a cell is split at the median of its projections on a random
   direction. Vectors near the split go to both sides (spill); the margin
   follows from the similarity. A cell's splits are found in one task on a
   sample of about ``sample`` of its vectors; all vectors are then sent through
   them. Cells that are still too large are split again, round by round. A cell
   that no direction divides is tight and stays whole.
3. How many trees a label gets follows from its size: each split tells what
   share of linked pairs it parts, and trees are added until the share of pairs
   that all of them part is under ``1 - recall``. A small label is one leaf.
4. Each cell's pairs are compared, large tight cells in pairs of blocks. A
   single-precision product finds the rows that could link, those are compared
   in double precision. A pair that meets in several cells counts in the cell
   with the smallest number only. A task returns one row per vector: its number
   of links there and the smallest vector it is joined to, never the pairs.
5. Those joins give the components.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
values, vectors without a label and rows without an id link with nothing and
are their own component; vectors of different lengths don't link; repeated
rows are copies of each other; empty tables give empty results; other columns
are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.components import components
from surveyloom.llm.tables import table, written

#: Bytes of trees that every task gets; more are joined to the vectors, so many of a cell at a time.
HANDED_TREES, ROUTED = 1 << 25, 20_000


class Settings(NamedTuple):
    """Limits of the forest; they are sent to the tasks, so all parts use the same ones."""

    threshold: float = 0.93
    #: Share of pairs right at the threshold that should meet in some leaf, by the splits' own estimate.
    recall: float = 0.996
    #: Vectors of a cell that isn't split, rows of a cell's sample, and vectors of a block of a tight cell.
    leaf: int = 1024
    sample: int = 2048
    block: int = 2048
    #: Half the margin in standard deviations of a linked pair's distance along a random direction.
    margin: float = 0.2
    #: Directions tried for a split, the share of a cell that a side may hold for the split to count, the least sample that is split.
    tries: int = 3
    shrink: float = 0.8
    least_sample: int = 64
    #: How vectors travel: as they are stored.
    kind: str = "<f8"

    def spill(self, d: int) -> float:
        return self.margin * np.sqrt((2 - 2 * self.threshold) / d)

    def parted(self, spilled: float) -> float:
        """Share of linked pairs that a split parts, from the share of vectors that it spills: how far a pair's distance reaches beyond both margins."""
        m = 2 * self.margin
        beyond = 2 * (math.exp(-m * m / 2) / math.sqrt(2 * math.pi) - m * 0.5 * math.erfc(m / math.sqrt(2)))
        return min(0.9, spilled * beyond / m)


def prepared(vectors: DataFrame) -> tuple[DataFrame, str]:
    """(vec_id, root, digest, raw) and the type in ``raw``: valid vectors as bytes; ``root`` is the cell of the label and the length, null for others."""
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "<f4" if single else "<f8"

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, digests, raws = [], [], []
            for key, label, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = None
                if key is not None and label is not None and values.is_valid and len(values) and values.values.null_count == 0:
                    x = values.values.to_numpy(zero_copy_only=False).astype(kind)
                    if np.isfinite(x).all() and x.any():
                        raw = (x + x.dtype.type(0)).tobytes()
                raws.append(raw)
                digests.append(None if raw is None else xxhash.xxh3_128_digest(raw))
                roots.append(None if raw is None else number(f"{label}/{len(values)}"))
            found = [pa.array(roots, pa.int64()), pa.array(digests, pa.binary()), pa.array(raws, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], names=["vec_id", "root", "digest", "raw"])

    values = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    own = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), values)
    return own.mapInArrow(to_bytes, "vec_id long, root long, digest binary, raw binary"), kind


def number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def unit(raws, kind: str) -> np.ndarray:
    """The vectors of one cell, each of length 1."""
    x = np.frombuffer(b"".join(raws), kind).astype("<f8").reshape(len(raws), -1)
    # by the largest component first: squares of huge and tiny ones leave the range of a double
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


@lru_cache(4096)
def direction(seed: int, d: int) -> np.ndarray:
    r = np.random.default_rng(abs(seed)).standard_normal(d)
    return r / np.linalg.norm(r)


def grow(x: np.ndarray, size: float, seed: int, use: Settings) -> tuple[list, float]:
    """A tree over the unit vectors ``x``, a sample of a cell of ``size`` vectors, and the share of linked pairs that it keeps together.

    Nested lists: [seed, median, left, right] or, for a leaf, ["open"] or ["tight"].
    """
    if size <= use.leaf:
        return ["open"], 1.0
    if len(x) < use.least_sample:
        # to be split in later rounds, as vectors without any order would be
        usual = use.parted(2 * use.margin * math.sqrt((2 - 2 * use.threshold) / (2 * math.pi)))
        return ["open"], (1 - usual) ** math.log2(size / use.leaf)
    margin = use.spill(x.shape[1])
    best = None
    for k in range(use.tries):
        own = number(f"{seed}/{k}")
        p = x @ direction(own, x.shape[1])
        middle = float(np.median(p))
        left, right = p <= middle + margin, p >= middle - margin
        most = max(left.mean(), right.mean())
        if best is None or most < best[0]:
            best = most, own, middle, left, right
    most, own, middle, left, right = best
    if most > use.shrink:
        return ["tight"], 1.0
    sides = [grow(x[s], size * s.mean(), number(f"{own}/{n}"), use) for n, s in (("left", left), ("right", right))]
    stay = np.average([k for _, k in sides], weights=[left.mean(), right.mean()])
    return [own, middle, *(t for t, _ in sides)], float(stay * (1 - use.parted(float((left & right).mean()))))


def grow_forest(x: np.ndarray, size: float, cell: int, use: Settings) -> list:
    """Trees until enough linked pairs stay together in at least one."""
    trees, lost = [], 1.0
    while lost > 1 - use.recall:
        tree, stay = grow(x, size, number(f"{cell}/{len(trees)}"), use)
        trees.append(tree)
        lost *= 1 - stay
    return trees


def leaves(tree: list, x: np.ndarray, rows: np.ndarray, name: str, margin: float) -> Iterator[tuple[str, bool, np.ndarray]]:
    """(name, tight, rows) of the leaves that the given rows reach."""
    if not len(rows):
        return
    if len(tree) == 1:
        yield name, tree[0] == "tight", rows
        return
    p = x[rows] @ direction(tree[0], x.shape[1])
    yield from leaves(tree[2], x, rows[p <= tree[1] + margin], name + "0", margin)
    yield from leaves(tree[3], x, rows[p >= tree[1] - margin], name + "1", margin)


def routed(cell: int, trees: list, reps: np.ndarray, raws: list, use: Settings) -> pd.DataFrame:
    """(rep, cell, tight): vectors of one cell sent through its trees."""
    x = unit(raws, use.kind)
    margin = use.spill(x.shape[1])
    found = [leaf for t, tree in enumerate(trees) for leaf in leaves(tree, x, np.arange(len(x)), f"{cell}/{t}/", margin)]
    sizes = [len(at) for _, _, at in found]
    return pd.DataFrame({
        "rep": reps[np.concatenate([at for _, _, at in found])],
        "cell": np.repeat([number(name) for name, _, _ in found], sizes),
        "tight": np.repeat([tight for _, tight, _ in found], sizes),
    })


LEAVES = "rep long, cell long, tight boolean"


def split_cells(inside: DataFrame, sizes: DataFrame, planted: Callable[..., list], use: Settings) -> DataFrame:
    """(rep, cell, tight): rows (rep, cell, raw) sent through the trees that ``planted`` grows in each cell; ``sizes`` has (cell, size)."""

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = unit(rows.sort_values("rep")["raw"].tolist(), use.kind)
        return pd.DataFrame({"cell": [key[0]], "plan": [json.dumps(planted(x, float(rows["size"].iloc[0]), int(key[0]), use))]})

    sized = inside.join(sizes, "cell")
    chance = F.pmod(F.xxhash64("rep", "cell"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # the expected sample is ``sample`` rows of a cell, whatever its size
    sample = sized.where(chance < F.lit(float(use.sample)) / F.col("size"))
    plans = written(sample.select("cell", "rep", "raw", "size").groupBy("cell").applyInPandas(fit, "cell long, plan string"), "plans")
    rows = inside.select("rep", "cell", "raw")
    if (plans.agg(F.sum(F.length("plan"))).first()[0] or 0) > HANDED_TREES:
        # a cell's trees meet so many of its vectors at a time
        salts = sizes.select("cell", F.ceil(F.col("size") / F.lit(ROUTED)).alias("salts"))
        rows = rows.join(salts, "cell").withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts"))).drop("salts")
        plans = plans.join(salts, "cell").select("cell", "plan", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))

        def meet(key: tuple, own: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
            if own.empty or plan.empty:
                return pd.DataFrame({"rep": [], "cell": [], "tight": []})
            return routed(int(key[0]), json.loads(plan["plan"].iloc[0]), own["rep"].to_numpy(), own["raw"].tolist(), use)

        return rows.groupBy("cell", "salt").cogroup(plans.groupBy("cell", "salt")).applyInPandas(meet, LEAVES)
    handed = inside.sparkSession.sparkContext.broadcast({r.cell: r.plan for r in plans.collect()})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[int, list] = {}
        for batch in batches:
            for cell, own in batch.to_pandas().groupby("cell", sort=False):
                if cell not in trees:
                    trees[cell] = json.loads(handed.value[cell])
                found = routed(int(cell), trees[cell], own["rep"].to_numpy(), own["raw"].tolist(), use)
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    return rows.mapInArrow(route, LEAVES)


def forest(reps: DataFrame, use: Settings = Settings()) -> DataFrame:
    """(rep, cell) of all classes in all trees; ``reps`` is a written table (rep, root, raw)."""
    first = reps.select("rep", F.col("root").alias("cell"), "raw")
    now = written(split_cells(first, first.groupBy("cell").agg(F.count(F.lit(1)).alias("size")), grow_forest, use), "cells")
    done = []
    while True:
        sizes = written(now.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.max("tight").alias("tight")), "sizes")
        large = sizes.where((F.col("size") > 2 * use.leaf) & ~F.col("tight")).select("cell", "size")
        if large.isEmpty():
            return_rows = now.select("rep", "cell")
            for x in done:
                return_rows = return_rows.unionByName(x)
            return return_rows
        done.append(now.join(large.select("cell"), "cell", "left_anti").select("rep", "cell"))
        inside = now.join(large.select("cell"), "cell", "left_semi").select("rep", "cell").join(reps.select("rep", "raw"), "rep")
        one = lambda x, size, cell, use: [grow(x, size, cell, use)[0]]
        now = written(split_cells(inside, large, one, use), "cells")


def links_of_block(key: tuple, rows: pd.DataFrame, use: Settings) -> pd.DataFrame:
    """Links between the blocks ``key`` = (cell, low, high), per vector."""
    rows = rows.sort_values("rep")
    cell, low, high = key
    x = unit(rows["raw"].tolist(), use.kind)
    block = rows["block"].to_numpy()
    a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
    # single precision finds the rows with links or nearly so, for which double precision decides
    rough = x.astype("<f4")
    near = rough[a] @ rough[b].T >= use.threshold - 1e-6 - 2e-7 * x.shape[1]
    if low == high:
        np.fill_diagonal(near, False)
    a, b = a[near.any(1)], b[near.any(0)]
    del near
    linked = x[a] @ x[b].T >= use.threshold
    linked &= a[:, None] != b[None, :]
    counted = linked
    if linked.any():
        # pairs that also meet in a cell with a smaller number count there
        cells = rows["cells"].to_numpy()
        own = [(k, side, c) for side, at in enumerate((a, b)) for k, r in enumerate(at) for c in cells[r] if c < cell]
        if own:
            at, side, names = (np.array(v) for v in zip(*own, strict=True))
            _, names = np.unique(names, return_inverse=True)
            both = np.intersect1d(names[side == 0], names[side == 1])
            if len(both):
                member = [np.zeros((len(v), len(both)), np.float32) for v in (a, b)]
                place = np.searchsorted(both, names)
                known = (place < len(both)) & (both[np.minimum(place, len(both) - 1)] == names)
                for s in (0, 1):
                    use_it = known & (side == s)
                    member[s][at[use_it], place[use_it]] = 1
                counted = linked & ~(member[0] @ member[1].T > 0)
    copies = rows["copies"].to_numpy(np.float64)
    links = np.zeros(len(rows))
    links[a] += counted @ copies[b]
    if low != high:
        links[b] += counted.T @ copies[a]
    # the smallest vector reached within the block: labels spread until nothing changes
    label = np.arange(len(rows))
    while len(a) and len(b):
        least = label.copy()
        least[a] = np.minimum(least[a], np.where(linked, label[b][None, :], len(rows)).min(1))
        least[b] = np.minimum(least[b], np.where(linked, label[a][:, None], len(rows)).min(0))
        least = least[least]
        if (least == label).all():
            break
        label = least
    reps = rows["rep"].to_numpy()
    return pd.DataFrame({"rep": reps, "links": links.astype(np.int64), "root": reps[label]})[links.astype(bool) | (label != np.arange(len(rows)))]


def near_links(reps: DataFrame, cells: DataFrame, use: Settings = Settings()) -> DataFrame:
    """(rep, links, root) rows; a class's links are the sum of its rows'. ``cells`` is a written table."""
    # cells of one block are the rule
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(use.block)).cast("int").alias("blocks")).where("blocks > 1")
    own = cells.groupBy("rep").agg(F.collect_set("cell").alias("cells")).join(reps.select("rep", "raw", "copies"), "rep")
    rows = own.select("*", F.explode("cells").alias("cell")).join(sizes, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    # one copy of a row for each block that its own meets
    dealt = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "raw", "copies", "cells")
    return dealt.groupBy("cell", "low", "high").applyInPandas(lambda key, pdf: links_of_block(key, pdf, use), "rep long, links long, root long")


def near_duplicates(vectors: DataFrame, use: Settings = Settings()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of rows (vec_id, label, embedding)."""
    rows, kind = prepared(vectors)
    use = use._replace(kind=kind)
    rows = written(rows, "vectors")
    valid = rows.where("raw IS NOT NULL")
    classes = valid.groupBy("root", "digest").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("raw").alias("raw"))
    reps = written(classes, "classes")
    found = written(near_links(reps, written(forest(reps, use), "forest"), use), "near")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    named = reps.select("root", "digest", "rep", "copies").join(linked, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left").select(
        "root", "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    return rows.select("vec_id", "root", "digest").join(named, ["root", "digest"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
