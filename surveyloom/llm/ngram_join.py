"""Exact Jaccard join on word n-grams by prefix trees.

1. Where documents are read, each becomes the set of hashes of its five-word
   shingles. Hashes travel in binary blocks to the partition that owns them,
   which counts the documents of each (document frequency) and sends the ones
   found in two or more documents back to their documents.
2. Sets are ordered from rare to frequent. A partner must share one of the
   first ``n - ceil(0.75 n) + 1`` shingles. Those found in no other document
   can be skipped, which leaves most documents without candidates. Documents
   that share such a shingle form candidate groups (connected components).
3. Each candidate group becomes a trie of its sets, most frequent shingles
   first so that similar sets share long paths. A set is matched against the
   whole trie at once: overlaps are counted once per shared path, and subtrees
   are left out where the remaining lengths can't give the required overlap or
   where all sets are already joined to it. Groups of more than ``BLOCK`` sets
   are split into pairs of blocks.
4. The links give the components. No pairs are written, only each set's joins.

Shingles found in one document only are in no intersection, so the counts of
the others and the set's size give the similarity exactly. Equal sets are
joined by their digest first.

Edge cases: a null text and a text without words have no shingles and link
with nothing; a text of fewer than five words has one shingle, the whole
sequence; repeated rows are copies of each other; a null id is never the
smallest of its component unless there is no other; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from surveyloom.llm.blocks import from_gaps, gaps, lean_batches, lean_group, mix, portions, ranges, runs, texts
from surveyloom.llm.components import components
from surveyloom.llm.tables import quoted, settled, table, written

WORDS = 5
#: Two sets link when DEN * intersection >= NUM * union.
NUM, DEN = 75, 100
#: Bytes of text hashed at once; shingles sent at once; bytes of text for each partition of shingles.
PORTION, WINDOW, TEXT_A_PARTITION = 1 << 20, 1 << 20, 1 << 23
#: Sets in a block of a trie and their bytes; sets of small groups in a task and their bytes.
BLOCK, BLOCK_BYTES, SETS_A_TASK, BYTES_A_TASK = 8192, 1 << 25, 2500, 1 << 24

#: Ids that are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 500_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0x9E3779B97F4A7C55)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)
TOKEN_BITS = 48

DOC = np.dtype([("uid", "<i8"), ("id", "<i8"), ("null", "u1"), ("n", "<i8"), ("d1", "<i8"), ("d2", "<i8")])
BLOCKS = "part int, base long, docs binary, counts binary, tokens binary"
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, at least n."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, BASE), np.full(size, INVERSE)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words of each text); A-Z in lower case, words are runs of anything but ASCII white space."""
    sizes = np.array([len(x) + 1 for x in raw], np.int64)
    data = LOWER[np.frombuffer(b" ".join([*raw, b""]), np.uint8)]
    space = SPACE[data]
    inside = np.concatenate([[False], ~space])
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    up, down = powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(LETTER[data] * down[: len(data)])])
    hashes = mix((sums[ends] - sums[starts]) * up[starts] + (ends - starts).astype(np.uint64) * STEP)
    edges = np.cumsum(sizes)
    return hashes, np.diff(np.searchsorted(starts, edges), prepend=0)


def shingle_sets(raw: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(raw)
    n = len(words)
    shingle = np.zeros(max(0, n - WORDS + 1), np.uint64)
    for k in range(WORDS):
        shingle = mix(shingle * STEP + words[k : k + len(shingle)])
    out, at = [], 0
    for c in counts.tolist():
        if c >= WORDS:
            out.append(np.unique(shingle[at : at + c - WORDS + 1]))
        elif c:
            h = np.full(1, c, np.uint64)
            for w in words[at : at + c]:
                h = mix(h * STEP + w + np.uint64(1))
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def set_digests(sets: list[np.ndarray]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]


def six(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : TOKEN_BITS // 8].tobytes()


def from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) * 8 // TOKEN_BITS, 8), np.uint8)
    out[:, : TOKEN_BITS // 8] = np.frombuffer(raw, np.uint8).reshape(-1, TOKEN_BITS // 8)
    return out.view("<u8").ravel()


def _block(part: int, base: int, docs: bytes, counts: bytes, tokens: bytes) -> pa.RecordBatch:
    arrays = [pa.array([part], pa.int32()), pa.array([base], pa.int64()), *(pa.array([x], pa.binary()) for x in (docs, counts, tokens))]
    return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in BLOCKS.split(", ")])


def shingle_blocks(docs: DataFrame, parts: int) -> DataFrame:
    """Shingles in blocks by the part that owns them (part >= 0), and the documents (part < 0)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 34
        keys: list[int | None] = []
        sets: list[np.ndarray] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = np.zeros(len(sets), DOC)
            rows["uid"] = uid + np.arange(len(sets))
            rows["id"], rows["null"] = [k or 0 for k in keys], [k is None for k in keys]
            rows["n"] = [len(s) for s in sets]
            digests = set_digests(sets)
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            rows["d1"], rows["d2"] = both[:, 0], both[:, 1]
            of = np.arange(len(sets)) * parts // max(1, len(sets))
            for q in np.unique(of):
                yield _block(-1 - int(q), uid, rows[of == q].tobytes(), b"", b"")
            # a set is sent once for all its copies in this window
            seen: set[bytes] = set()
            first = [i for i, d in enumerate(digests) if len(sets[i]) and not (d in seen or seen.add(d))]
            if not first:
                return
            tokens = np.concatenate([sets[i] for i in first]) >> np.uint64(64 - TOKEN_BITS)
            owner = np.repeat(np.array(first, np.int32), [len(sets[i]) for i in first])
            part = (tokens % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
            tokens, owner, part = tokens[order], owner[order], part[order]
            for a, n in zip(*runs(part), strict=True):
                # a byte for the document of each shingle, however many parts there are
                yield _block(int(part[a]), uid, gaps(owner[a : a + n]), b"", six(tokens[a : a + n]))

        for batch in batches:
            raw, ids = texts(batch.column(1)), batch.column(0).to_pylist()
            for s in portions([len(x) for x in raw], PORTION):
                own = shingle_sets(raw[s])
                keys += ids[s]
                sets += own
                held += sum(map(len, own))
                if held >= WINDOW:
                    yield from out()
                    uid += len(sets)
                    keys, sets, held = [], [], 0
        if keys:
            yield from out()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean_batches(blocks), BLOCKS)


def frequencies(parts: int):
    """A group function: one part's blocks -> shingles with a frequency of at least two, by the part of their document."""

    def count(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        if part < 0:
            return pd.DataFrame({"part": [-1 - part] * len(group), "base": 0, "docs": group["docs"], "counts": b"", "tokens": b""})
        group = group.sort_values("base")
        tokens = np.concatenate([from_six(x) for x in group["tokens"]])
        uids = np.concatenate([b + from_gaps(d) for b, d in zip(group["base"], group["docs"], strict=True)])
        order = np.argsort(tokens, kind="stable")
        starts, lengths = runs(tokens[order])
        often = lengths > 1
        kept = order[ranges(starts[often], lengths[often])]
        # the upper half of a float: any count, in order, to eight binary digits
        frequency = np.repeat(lengths[often].astype(np.float32).view(np.uint32) >> 16, lengths[often]).astype(np.uint64)
        keys, uids = (frequency << np.uint64(TOKEN_BITS)) | tokens[kept], uids[kept]
        order = np.argsort(uids, kind="stable")
        keys, uids = keys[order], uids[order]
        s, c = runs(uids)
        ids = uids[s]
        to = (mix(ids.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        rows = []
        for q in np.unique(to):
            own = to == q
            rows.append((int(q), 1, ids[own].tobytes(), c[own].astype("<u4").tobytes(), keys[ranges(s[own], c[own])].tobytes()))
        return pd.DataFrame(rows, columns=["part", "base", "docs", "counts", "tokens"])

    return count


def spread_docs(parts: int):
    """A group function that deals the documents' rows by their own number, as their shingles are dealt."""
    count = frequencies(parts)

    def deal(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if int(key[0]) >= 0:
            return count(key, group)
        rows = np.frombuffer(b"".join(group["docs"]), DOC)
        to = (mix(rows["uid"].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        out = [(int(q), 0, rows[to == q].tobytes(), b"", b"") for q in np.unique(to)]
        return pd.DataFrame(out, columns=["part", "base", "docs", "counts", "tokens"])

    return deal


SETS = "uid long, doc_id long, n long, d1 long, d2 long, prefix array<long>, keys binary, size long"


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - -(-NUM * n // DEN) + 1


def ordered_sets(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Documents of one part with their shared shingles from rare to frequent, and the prefix of these that partners must meet."""
    docs = np.frombuffer(b"".join(group.loc[group["base"] == 0, "docs"]), DOC)
    docs = docs[np.argsort(docs["uid"])]
    shared = group[group["base"] == 1]
    uids = np.concatenate([np.repeat(np.frombuffer(d, "<i8"), np.frombuffer(c, "<u4")) for d, c in zip(shared["docs"], shared["counts"], strict=True)] or [np.zeros(0, np.int64)])
    keys = np.frombuffer(b"".join(shared["tokens"]), "<u8")
    order = np.lexsort((keys, uids))
    uids, keys = uids[order], keys[order]
    at = np.searchsorted(uids, docs["uid"])
    count = np.searchsorted(uids, docs["uid"], "right") - at
    take = np.clip(prefix_length(docs["n"]) - (docs["n"] - count), 0, count)
    prefixes = [keys[a : a + k].astype(np.int64) if k > 0 else None for a, k in zip(at, take, strict=True)]
    blobs = [keys[a : a + c].tobytes() if k > 0 else None for a, c, k in zip(at, count, take, strict=True)]
    ids = pd.array(docs["id"], dtype="Int64")
    ids[docs["null"] == 1] = pd.NA
    return pd.DataFrame({"uid": docs["uid"], "doc_id": ids, "n": docs["n"], "d1": docs["d1"], "d2": docs["d2"], "prefix": prefixes, "keys": blobs, "size": 8 * count})


class Trie:
    """Compressed trie of sorted sequences of small numbers.

    Node k has a label (a slice of a sequence), children, the sequences that end there, and for its subtree the longest
    path from the root and the smallest set size, which bound what an overlap can still become.
    """

    def __init__(self, sequences: list[np.ndarray], sizes: np.ndarray) -> None:
        order = sorted(range(len(sequences)), key=lambda i: sequences[i].astype(">u4").tobytes())
        self.label: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.depth, self.children, self.ends = [0], [[]], [[]]
        path = [0]  # open nodes from the root to the last inserted end
        last = np.zeros(0, np.int64)
        for i in order:
            s = sequences[i]
            m = min(len(s), len(last))
            differ = np.flatnonzero(s[:m] != last[:m])
            common = int(differ[0]) if len(differ) else m
            while self.depth[path[-1]] > common:
                node = path.pop()
                if self.depth[path[-1]] < common:
                    # the label of `node` is split at the end of the common part
                    cut = common - self.depth[path[-1]]
                    upper = self._node(self.label[node][:cut], common)
                    self.children[path[-1]][-1] = upper
                    self.children[upper].append(node)
                    self.label[node] = self.label[node][cut:]
                    path.append(upper)
            if common < len(s):
                node = self._node(s[common:], len(s))
                self.children[path[-1]].append(node)
                path.append(node)
            self.ends[path[-1]].append(i)
            last = s
        n = len(self.label)
        self.longest, self.least = [0] * n, [1 << 60] * n
        for node in self._upwards():
            below = self.children[node]
            self.longest[node] = max([self.depth[node] if self.ends[node] else 0, *(self.longest[c] for c in below)])
            self.least[node] = min([*(int(sizes[i]) for i in self.ends[node]), *(self.least[c] for c in below)], default=1 << 60)

    def _node(self, label: np.ndarray, depth: int) -> int:
        self.label.append(label)
        self.depth.append(depth)
        self.children.append([])
        self.ends.append([])
        return len(self.label) - 1

    def _upwards(self) -> list[int]:
        out, stack = [], [0]
        while stack:
            out.append(node := stack.pop())
            stack += self.children[node]
        return out[::-1]


def trie_links(sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray | None = None) -> np.ndarray:
    """For each set the smallest set it is joined to through links; with sides only links between the two sides count."""
    whole = np.concatenate(sets)
    tokens, ids, frequency = np.unique(whole, return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, -frequency))] = np.arange(len(tokens))
    ends = np.cumsum([len(s) for s in sets])
    sequences = [np.sort(x) for x in np.split(rank[ids], ends[:-1])]
    trie = Trie(sequences, sizes)
    parent = list(range(len(sets)))

    def find(a: int) -> int:
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        return a

    joined: list[int | None] = [None] * len(trie.label)  # a set to which all of the subtree are joined
    for node in trie._upwards():
        below = {x for c in trie.children[node] for x in (joined[c],)} | set(trie.ends[node])
        joined[node] = below.pop() if len(below) == 1 else None
    member = np.zeros(len(tokens), bool)
    for x, own in enumerate(sequences):
        member[own] = True
        size = int(sizes[x])
        stack = [(0, 0)]  # node, overlap of its path without its label
        while stack:
            node, overlap = stack.pop()
            if joined[node] is not None and find(joined[node]) == find(x):
                continue
            label = trie.label[node]
            if len(label):
                overlap += int(np.count_nonzero(member[label]))
                rest_own = len(own) - int(np.searchsorted(own, label[-1], "right"))
            else:
                rest_own = len(own)
            most = overlap + min(rest_own, trie.longest[node] - trie.depth[node])
            # DEN * o >= NUM * (size + other - o), with the smallest other size below
            if (DEN + NUM) * most < NUM * (size + trie.least[node]):
                continue
            for y in trie.ends[node]:
                if y != x and (side is None or side[x] != side[y]) and (DEN + NUM) * overlap >= NUM * (size + int(sizes[y])):
                    a, b = find(x), find(y)
                    parent[max(a, b)] = min(a, b)
            stack += [(c, overlap) for c in trie.children[node]]
        member[own] = False
    return np.array([find(i) for i in range(len(sets))])


def links_of_groups(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """(uid, root) of the candidate groups dealt to one task."""
    out = []
    for (_, low, high), own in rows.groupby(["cand", "low", "high"], sort=False):
        own = own.sort_values("uid")
        uids = own["uid"].to_numpy()
        side = (own["block"] == low).to_numpy() if low != high else None
        root = trie_links([np.frombuffer(x, "<u8") for x in own["keys"]], own["n"].to_numpy(), side)
        moved = root != np.arange(len(root))
        out.append(pd.DataFrame({"uid": uids[moved], "root": uids[root[moved]]}))
    return pd.concat(out)


def task_of(tasks: int) -> list[Column]:
    """(task, own) of dealt rows: groups of one block share ``tasks`` tasks, each pair of blocks of a larger group is a task of its own."""
    alone = F.col("blocks") == 1
    return [F.when(alone, F.pmod(F.xxhash64("cand"), F.lit(tasks))).alias("task"), F.when(~alone, F.col("cand")).alias("own")]


def joined_rows(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, n, d1, d2, component, component_id) of rows (doc_id, text); no component for those without shingles."""
    docs = settled(docs.select("doc_id", "text"), "documents")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // TEXT_A_PARTITION))
    counted = shingle_blocks(docs, parts).groupBy("part").applyInPandas(lean_group(spread_docs(parts)), BLOCKS)
    sets = written(counted.groupBy("part").applyInPandas(lean_group(ordered_sets), SETS), "sets")

    classes = written(sets.where("n > 0").groupBy("d1", "d2").agg(F.min("uid").alias("rep")), "set-classes")
    firsts = sets.where("prefix IS NOT NULL").join(classes.select(F.col("rep").alias("uid")), "uid", "left_semi")
    prefixes = firsts.select("uid", F.explode("prefix").alias("token"))
    least = prefixes.groupBy("token").agg(F.min("uid").alias("v"), F.count(F.lit(1)).alias("docs")).where("docs > 1").select("token", "v")
    groups = written(components(prefixes.join(least, "token").where("uid <> v").select(F.col("uid").alias("u"), "v")), "candidates")

    members = groups.select(F.col("id").alias("uid"), F.col("component").alias("cand")).join(sets.select("uid", "size"), "uid")
    n_blocks = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), F.ceil(F.sum("size") / F.lit(BLOCK_BYTES)), F.lit(1)).cast("int")
    blocks = members.groupBy("cand").agg(n_blocks.alias("blocks"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    blocks = written(blocks, "groups")
    few = blocks.where("blocks = 1").agg(F.sum("n"), F.sum("size")).first()
    tasks = max(1, -(-(few[0] or 0) // SETS_A_TASK), -(-(few[1] or 0) // BYTES_A_TASK))
    dealt = (
        groups.select(F.col("id").alias("uid"), F.col("component").alias("cand"))
        .join(blocks.select("cand", "blocks"), "cand")
        .withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cand", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "blocks", "uid")
        .join(sets.select("uid", "n", "keys"), "uid")
    )
    links = dealt.select(*task_of(tasks), "*").groupBy("task", "own", "low", "high").applyInPandas(lean_group(links_of_groups), "uid long, root long")
    joined = components(written(links, "links").select(F.col("uid").alias("u"), F.col("root").alias("v")))

    own = sets.select("uid", "doc_id", "n", "d1", "d2").join(classes, ["d1", "d2"], "left")
    placed = own.where("n > 0").join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left")
    placed = placed.select("uid", "doc_id", "n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    ids = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    none = sets.where("n = 0").select("uid", "doc_id", "n", "d1", "d2", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id"))
    return placed.join(ids, "component").select(none.columns).unionByName(none)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of rows (doc_id, text)."""
    return joined_rows(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def with_digests(docs: DataFrame) -> DataFrame:
    """(row, key, text, n, d1, d2): rows as they are, their ids, and size and digest of their shingle sets."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: list[np.ndarray] = []
            raw = texts(batch.column(2))
            for s in portions([len(x) for x in raw], PORTION):
                sets += shingle_sets(raw[s])
            both = np.frombuffer(b"".join(set_digests(sets)), "<i8").reshape(-1, 2)
            found = [pa.array(np.array(x, np.int64)) for x in ([len(s) for s in sets], both[:, 0], both[:, 1])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=["row", "key", "text", "n", "d1", "d2"])

    packed = docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("key"), "text")
    schema = StructType([*packed.schema.fields, *(StructField(c, LongType()) for c in ("n", "d1", "d2"))])
    return packed.mapInArrow(lean_batches(digests), schema)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of near-duplicates, with all its columns: the smallest by (id, nulls last; row read first).

    Rows without words are in no component; of those with equal ids and texts one stays, those without an id all stay.
    """
    found = written(joined_rows(docs), "near-copies")
    twice = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    twice = written(twice, "repeated-ids")
    # an id found once stands for its row
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    unclear = not twice.isEmpty() or not found.where("doc_id IS NULL").isEmpty()
    n = gone.count()
    if n <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    if not unclear:
        return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti").select(quoted(docs.columns))
    again = twice.select(F.col("doc_id").alias("again"))
    once = docs.where("doc_id IS NOT NULL").join(again, docs["doc_id"] == F.col("again"), "left_anti")
    left = once.join(gone, once["doc_id"] == gone["gone"], "left_anti").select(quoted(docs.columns))
    # repeated and null ids: the first row of a component that has the component's id, known by its id and set
    least = found.where("n > 0").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    least = least.where("doc_id IS NULL").unionByName(least.join(twice, "doc_id", "left_semi").select(least.columns))
    first = least.groupBy("component").agg(F.min_by(F.struct("doc_id", "d1", "d2"), "uid").alias("first")).select("first.*")
    first = written(first.select(F.col("doc_id").alias("first_id"), F.col("d1").alias("first_d1"), F.col("d2").alias("first_d2")), "first-rows")
    rows = docs.where("doc_id IS NULL").unionByName(docs.join(again, docs["doc_id"] == F.col("again"), "left_semi"))
    rows = with_digests(rows)
    same = F.col("key").eqNullSafe(F.col("first_id")) & (F.col("d1") == F.col("first_d1")) & (F.col("d2") == F.col("first_d2"))
    kept = rows.where("n > 0").join(first, same, "left_semi").dropDuplicates(["key", "d1", "d2"])
    wordless = rows.where("n = 0")
    wordless = wordless.where("key IS NULL").unionByName(wordless.where("key IS NOT NULL").dropDuplicates(["key", "text"]))
    return left.unionByName(kept.unionByName(wordless).select("row.*"))
