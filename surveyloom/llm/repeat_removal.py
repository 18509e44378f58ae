"""Removal of repeated passages by a sparse enhanced suffix array.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier
in the corpus. Windows of that length are too many to sort, so only anchors
are: of the ``SEED``-byte seeds in each window the one with the smallest hash.
Equal windows choose equal anchors at the same offset, so every repeat of the
required length holds an anchor whose seed is found at least twice.

1. Anchors go in binary blocks to the partition that owns their hash, which
   keeps those found at least twice and sends their places back. A hash that a
   task has met twice is settled there and sent once, so a frequent one costs
   its owner a place for each block of text, not for each document.
2. The anchors' surroundings (all that a window around them can hold) go to
   the partition that owns the seed. Equal surroundings are one entry; within
   a task this is done before anything is sent.
3. There the suffixes that begin at the anchors are sorted, with the lengths of
   the common prefixes of neighbours. A stack scan yields the tree of
   common-prefix intervals. The occurrences of each interval are compared
   leftwards in the same way; where left extensions differ a repeat ends, which
   gives the maximal repeats with all their occurrences. In each all but the
   first occurrence are covered.
4. A partition that holds more than ``HOT_PLACES`` different surroundings (the
   edge of a passage that is in very many documents) is not scanned in one
   task: each of its windows of ``LENGTH`` bytes becomes a row, the first in
   the corpus is found by aggregation, and all later ones are covered.
5. Spans are united for each document and cut out.

Equal texts are compared by digest first: only the first of them takes part,
the others are removed whole.

Edge cases: a null text is empty; a text under ``LENGTH`` bytes keeps all
bytes; of equal ids the row read first is the earlier document and null ids are
the last; repeated rows are copies; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from surveyloom.llm.blocks import lean_batches, lean_group, mix, portions, ranges, runs, texts
from surveyloom.llm.ngram_join import LETTER, TOKEN_BITS, from_six, powers, six
from surveyloom.llm.tables import quoted, settled, table, written

LENGTH, SEED = 100, 48
LEFT = LENGTH - SEED
#: Bytes of text handled at once; of text sent at once; bytes of text and of surroundings for each partition.
PORTION, WINDOW, TEXT_A_PARTITION, SENT_A_PARTITION = 1 << 20, 1 << 24, 1 << 24, 1 << 23
#: Bits for each key of the filter that keeps texts without work from being moved, and its least and largest size (64 MB).
FILTER_BITS, LEAST_FILTER, LARGEST_FILTER = 16, 1 << 18, 1 << 29
#: Spans gathered before they are united.
SPANS_HELD = 1 << 18
#: Surroundings of a partition (152 bytes each) that a task sorts; more are compared window by window, in rows.
HOT_PLACES = 1 << 19

ANCHORS = "part int, base long, docs binary, counts binary, hashes binary, places binary"
SENT = "part int, rows binary, bytes binary"
AROUND = np.dtype([("uid", "<i8"), ("id", "<i8"), ("null", "u1"), ("pos", "<i4"), ("left", "u1"), ("right", "u1")])
SPAN = np.dtype([("uid", "<i8"), ("start", "<i4"), ("end", "<i4")])


def sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    size, y = 1, x
    while size * 2 <= width:
        y = op(y[:-size], y[size:])
        size *= 2
    rest = width - size
    return op(y[: len(y) - rest], y[rest:]) if rest else y


def anchors(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, seed hash) of the anchors of all texts."""
    sizes = np.array([len(x) for x in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    if len(data) < LENGTH:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(LETTER[data] * down[: len(data)])])
    seeds = mix((sums[SEED:] - sums[:-SEED]) * up[: len(data) - SEED + 1]) | np.uint64(1)
    count = LENGTH - SEED + 1
    least = sliding(np.minimum, seeds, count)
    # windows that run over the end of their text choose nothing
    ends = np.cumsum(sizes)
    for a, b in zip(np.maximum(ends - sizes, ends - LENGTH + 1), ends, strict=True):
        least[a:b] = 0
    edge = np.zeros(count - 1, np.uint64)
    chosen = sliding(np.maximum, np.concatenate([edge, least, edge]), count)
    at = np.flatnonzero(chosen == seeds)
    owner = np.searchsorted(ends, at, "right")
    return owner.astype(np.int32), at - (ends - sizes)[owner], seeds[at]


def owner_of(uids: np.ndarray, parts: int) -> np.ndarray:
    return (mix(uids.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def places_by_part(uids: np.ndarray, places: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(part, documents, places of each, places) by the part of the document."""
    order = np.lexsort((places, uids))
    uids, places = uids[order], places[order]
    s, c = runs(uids)
    to = owner_of(uids[s], parts)
    for q in np.unique(to):
        own = to == q
        yield int(q), uids[s[own]].tobytes(), c[own].astype("<u4").tobytes(), places[ranges(s[own], c[own])].tobytes()


def anchor_blocks(docs: DataFrame, parts: int) -> DataFrame:
    """Anchors in blocks by the part that owns them (part >= 0), the documents (-parts <= part < 0), and settled places (part < -parts)."""
    names = [x.split()[0] for x in ANCHORS.split(", ")]

    def block(part: int, base: int, *cells: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([base], pa.int64()), *(pa.array([x], pa.binary()) for x in cells)], names=names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 34
        keys: list[int | None] = []
        raw: list[bytes] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            digests = [hashlib.sha256(x).hexdigest() for x in raw]
            rows = pd.DataFrame({"uid": uid + np.arange(len(raw)), "doc_id": pd.array(keys, dtype="Int64"), "n": [len(x) for x in raw], "sha": digests})
            for q, own in rows.groupby(np.arange(len(raw)) * parts // len(raw)):
                yield block(-1 - int(q), uid, own.to_json(orient="values").encode(), b"", b"", b"")
            # of equal texts in this window only the first takes part
            order = sorted(range(len(raw)), key=lambda i: (keys[i] is None, keys[i] or 0, i))
            seen: set[str] = set()
            first = sorted(i for i in order if len(raw[i]) >= LENGTH and not (digests[i] in seen or seen.add(digests[i])))
            found = []
            for s in portions([len(raw[i]) for i in first], PORTION):
                own = np.array(first[s], np.int32)
                number, place, seed = anchors([raw[i] for i in first[s]])
                found.append((own[number], place, seed))
            if not found:
                return
            owner, place, seed = (np.concatenate(x) for x in zip(*found, strict=True))
            tokens = seed >> np.uint64(64 - TOKEN_BITS)
            # seeds found twice here are settled; their first place tells the owner that there is one
            order = np.argsort(tokens, kind="stable")
            starts, lengths = runs(tokens[order])
            again = order[ranges(starts[lengths > 1], lengths[lengths > 1])]
            for q, *cells in places_by_part(uid + owner[again].astype(np.int64), place[again].astype("<i4"), parts):
                yield block(-1 - parts - q, uid, *cells[:2], b"", cells[2])
            sent = np.sort(order[starts])
            owner, place, tokens = owner[sent], place[sent], tokens[sent]
            part = (tokens % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
            owner, place, tokens, part = owner[order], place[order].astype("<i4"), tokens[order], part[order]
            for a, n in zip(*runs(part), strict=True):
                s, c = runs(owner[a : a + n])
                yield block(int(part[a]), uid, owner[a : a + n][s].tobytes(), c.astype("<u4").tobytes(), six(tokens[a : a + n]), place[a : a + n].tobytes())

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                keys.append(key)
                raw.append(text)
                held += len(text)
                if held >= WINDOW:
                    yield from out()
                    uid += len(raw)
                    keys, raw, held = [], [], 0
        if keys:
            yield from out()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean_batches(blocks), ANCHORS)


FOUND = "kind int, part int, docs binary, counts binary, places binary, uid long, doc_id long, n long, sha string"


def repeated_anchors(key: tuple, group: pd.DataFrame, parts: int) -> pd.DataFrame:
    """One part's blocks -> places of seeds found at least twice, by the part of their document; documents pass as rows."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    part = int(key[0])
    if part < -parts:
        out = group[["docs", "counts", "places"]].assign(kind=1, part=-1 - parts - part, uid=None, doc_id=None, n=None, sha=None)
        return out[names].astype({c: "Int64" for c in ("uid", "doc_id", "n")})
    if part < 0:
        rows = [x for cell in group["docs"] for x in json.loads(cell)]
        out = pd.DataFrame(rows, columns=["uid", "doc_id", "n", "sha"]).astype({"doc_id": "Int64"})
        return out.assign(kind=0, part=0, docs=b"", counts=b"", places=b"")[names]
    tokens = np.concatenate([from_six(x) for x in group["hashes"]])
    uids = np.concatenate([np.repeat(np.int64(b) + np.frombuffer(d, "<i4"), np.frombuffer(c, "<u4")) for b, d, c in zip(group["base"], group["docs"], group["counts"], strict=True)])
    places = np.frombuffer(b"".join(group["places"]), "<i4")
    order = np.argsort(tokens, kind="stable")
    starts, lengths = runs(tokens[order])
    often = lengths > 1
    kept = order[ranges(starts[often], lengths[often])]
    uids, places = uids[kept], places[kept]
    rows = [(1, *cells, None, None, None, None) for cells in places_by_part(uids, places, parts)]
    return pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in ("uid", "doc_id", "n")})


def places_of_docs(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    uids = np.repeat(np.frombuffer(b"".join(group["docs"]), "<i8"), np.frombuffer(b"".join(group["counts"]), "<u4"))
    places = np.frombuffer(b"".join(group["places"]), "<i4")
    order = np.lexsort((places, uids))
    uids, places = uids[order], places[order]
    # a place may be known to its task and to the owner of its seed
    new = np.ones(len(uids), bool)
    new[1:] = (uids[1:] != uids[:-1]) | (places[1:] != places[:-1])
    uids, places = uids[new], places[new]
    s, c = runs(uids)
    return pd.DataFrame({"uid": uids[s], "places": [places[a : a + n].tobytes() for a, n in zip(s, c, strict=True)], "n_places": c})


def likely(rows: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """The rows whose ``key`` is in ``keys`` (one column "key", a written table), and a few others.

    A bit map sized by the number of keys is broadcast, up to ``LARGEST_FILTER`` bits. Beyond two bits a key at that size
    (some 270 million keys) most rows would pass, so all do: the join that follows then moves all texts once.
    """
    n = keys.count()
    bits = max(LEAST_FILTER, min(LARGEST_FILTER, 1 << (FILTER_BITS * max(1, n) - 1).bit_length()))
    if bits < 2 * n:
        return rows
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    maps = keys.select(bit(F.col("key")).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    at = F.bitmap_bit_position(bit(key))
    byte = F.conv(F.hex(F.substring(F.col("map"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    joined = rows.withColumn("bucket", F.bitmap_bucket_number(bit(key))).join(F.broadcast(maps), "bucket")
    return joined.where(F.call_function("getbit", byte, F.pmod(at, F.lit(8)).cast("int")) == 1).select(*rows.columns)


def collapsed(around: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries to keep in sorted order, entries covered whole): of equal surroundings the first in the corpus is kept."""
    width = data.shape[1]
    text = np.ascontiguousarray(data).view(f"S{width}").ravel()
    rank = np.lexsort((around["pos"], around["uid"], around["id"], around["null"]))
    lengths = around["left"].astype(np.int64) * 256 + around["right"]
    order = rank[np.lexsort((lengths[rank], text[rank]))]
    same = (text[order][1:] == text[order][:-1]) & (lengths[order][1:] == lengths[order][:-1])
    new = np.concatenate([[True], ~same]) if len(order) else np.zeros(0, bool)
    return order[new], order[~new]


def surroundings(raw: bytes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes from LEFT before to LENGTH after each place, how many of them on the left and on the right are text)."""
    data = np.frombuffer(bytes(LEFT) + raw + bytes(LENGTH), np.uint8)
    around = np.lib.stride_tricks.sliding_window_view(data, LEFT + LENGTH)[places]
    return around, np.minimum(places, LEFT), np.minimum(len(raw) - places, LENGTH)


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans sorted by document and start, without overlaps."""
    spans = spans[np.lexsort((spans["start"], spans["uid"]))]
    if not len(spans):
        return spans
    starts, lengths = runs(spans["uid"])
    document = np.repeat(np.arange(len(starts), dtype=np.int64) << 32, lengths)
    reach = np.maximum.accumulate(document + spans["end"])
    new = np.concatenate([[True], document[1:] + spans["start"][1:] > reach[:-1]])
    out = spans[new]
    out["end"] = (reach & 0xFFFFFFFF)[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]
    return out


def spans_by_part(spans: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    spans = merged(spans)
    to = owner_of(spans["uid"], parts)
    for q in np.unique(to):
        yield int(q), spans[to == q].tobytes()


def span_rows(around: np.ndarray, left, right) -> np.ndarray:
    out = np.zeros(len(around), SPAN)
    out["uid"], out["start"], out["end"] = around["uid"], around["pos"] - left, around["pos"] + right
    return out


def surrounding_blocks(marked: DataFrame, parts: int, places: int) -> DataFrame:
    """Surroundings by the part that owns their seed (part >= 0), and spans that are settled already (part < 0)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[int] = set()
        held = 0

        def block(part: int, rows: bytes, cells: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([rows], pa.binary()), pa.array([cells], pa.binary())], names=["part", "rows", "bytes"])

        def out() -> Iterator[pa.RecordBatch]:
            around, data = (np.concatenate(x) for x in zip(*kept, strict=True))
            keep, covered = collapsed(around, data)
            own = around[covered]
            for q, spans in spans_by_part(span_rows(own, own["left"].astype(np.int32), own["right"].astype(np.int32)), places):
                yield block(-1 - q, spans, b"")
            around, data = around[keep], data[keep]
            seed = np.ascontiguousarray(data[:, LEFT : LEFT + SEED]).view("<u8")
            h = np.zeros(len(seed), np.uint64)
            for k in range(seed.shape[1]):
                h = mix(h + seed[:, k] + np.uint64(k + 1))
            part = (h % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            for a, n in zip(*runs(part[order]), strict=True):
                i = order[a : a + n]
                yield block(int(part[i[0]]), around[i].tobytes(), squeeze(data[i].tobytes()))

        for batch in batches:
            for uid, key, text, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                # rows with equal ids and texts join the same mark: they are one text, not copies of each other
                if uid in seen:
                    continue
                seen.add(uid)
                where = np.frombuffer(at, "<i4").astype(np.int64)
                data, left, right = surroundings(text, where)
                around = np.zeros(len(where), AROUND)
                around["uid"], around["id"], around["null"] = uid, key or 0, key is None
                around["pos"], around["left"], around["right"] = where, left, right
                kept.append((around, data))
                held += data.size
                if held >= WINDOW:
                    yield from out()
                    kept, held = [], 0
                    seen.clear()
        if kept:
            yield from out()

    return marked.select("uid", "doc_id", "text", "places").mapInArrow(lean_batches(blocks), SENT)


def common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of ``a`` and ``b``, ``most`` at most."""
    differ = a != b
    first = differ.argmax(1)
    return np.minimum(np.where(differ[np.arange(len(first)), first], first, a.shape[1]), most)


def intervals(lengths: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, length) of the common-prefix intervals of sorted strings: a stack scan over neighbours' common lengths."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lengths, -1]):
        begin = i
        while stack and stack[-1][0] > value:
            top, begin = stack.pop()
            yield begin, i, top
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, begin))


def maximal_repeats(right: np.ndarray, left: np.ndarray, right_n: np.ndarray, left_n: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """(occurrences, bytes to the left, bytes to the right) of the repeats of LENGTH bytes and more around one seed.

    Rows must be sorted by ``right``; ``left`` is read away from the anchor.
    """
    lcp = common(right[1:], right[:-1], np.minimum(right_n[1:], right_n[:-1])).tolist()
    for a, b, r in intervals(lcp, SEED):
        own = np.arange(a, b + 1)
        if len(own) > 2:
            text = np.ascontiguousarray(left[own]).view(f"S{left.shape[1]}").ravel()
            own = own[np.argsort(text, kind="stable")]
        # left extensions: equal ones lengthen the repeat, diverse ones end it
        lcs = common(left[own[1:]], left[own[:-1]], np.minimum(left_n[own[1:]], left_n[own[:-1]])).tolist()
        for c, d, n in intervals(lcs, max(0, LENGTH - r)):
            yield own[c : d + 1], n, r


def covered_spans(around: np.ndarray, data: np.ndarray) -> np.ndarray:
    """All covered spans among the surroundings of one part."""
    out = [np.zeros(0, SPAN)]
    held = 0

    def cover(i: np.ndarray, left, right) -> None:
        nonlocal held
        out.append(span_rows(around[i], left, right))
        held += len(i)
        if held > SPANS_HELD:
            out[:] = [merged(np.concatenate(out))]
            held = 0

    keep, copies = collapsed(around, data)
    cover(copies, around["left"][copies].astype(np.int32), around["right"][copies].astype(np.int32))
    around, data = around[keep], data[keep]
    # numbers in the order of the corpus
    rank = np.empty(len(around), np.int64)
    rank[np.lexsort((around["pos"], around["uid"], around["id"], around["null"]))] = np.arange(len(around))
    right = np.ascontiguousarray(data[:, LEFT:])
    order = np.argsort(right.view(f"S{LENGTH}").ravel(), kind="stable")
    right, around, rank = right[order], around[order], rank[order]
    left = np.ascontiguousarray(data[order, LEFT - 1 :: -1] if LEFT else data[order, :0])
    del data
    right_n, left_n = around["right"].astype(np.int64), around["left"].astype(np.int64)
    seed = np.ascontiguousarray(right[:, :SEED]).view(f"V{SEED}").ravel()
    starts, sizes = runs(seed)
    # two occurrences: one repeat, without a tree
    two = starts[sizes == 2]
    if len(two):
        r = common(right[two], right[two + 1], np.minimum(right_n[two], right_n[two + 1]))
        n = common(left[two], left[two + 1], np.minimum(left_n[two], left_n[two + 1]))
        later = np.where(rank[two] > rank[two + 1], two, two + 1)
        enough = r + n >= LENGTH
        cover(later[enough], n[enough], r[enough])
    for a, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        s = slice(a, a + n)
        for own, to_left, to_right in maximal_repeats(right[s], left[s], right_n[s], left_n[s]):
            own = own + a
            cover(own[own != own[np.argmin(rank[own])]], to_left, to_right)
    return np.concatenate(out)


def occurrences(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(places, bytes around them) of one part."""
    unsqueeze = zstandard.ZstdDecompressor().decompress
    around = np.frombuffer(b"".join(group["rows"]), AROUND)
    data = np.frombuffer(b"".join(map(unsqueeze, group["bytes"])), np.uint8).reshape(-1, LEFT + LENGTH)
    # a row that was read twice is one occurrence
    _, once = np.unique(around[["uid", "pos"]], return_index=True)
    return (around, data) if len(once) == len(around) else (around[once], data[once])


def spans_of_part(key: tuple, group: pd.DataFrame, places: int) -> pd.DataFrame:
    part = int(key[0])
    if part < 0:
        return group[["part", "rows"]].assign(part=-1 - part)
    found = covered_spans(*occurrences(group))
    return pd.DataFrame(list(spans_by_part(found, places)), columns=["part", "rows"])


def windows(around: DataFrame) -> DataFrame:
    """(h1, h2, at): digest and place (no id, id, uid, start) of all windows of LENGTH bytes around the anchors of blocks ``SENT``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unsqueeze = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for found, cells in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                places = np.frombuffer(found, AROUND)
                data = np.frombuffer(unsqueeze(cells), np.uint8).reshape(-1, LEFT + LENGTH)
                for k in range(LEFT + 1):
                    fits = (places["left"] >= k) & (places["right"] >= LENGTH - k)
                    own = places[fits]
                    text = np.ascontiguousarray(data[fits, LEFT - k : LEFT - k + LENGTH]).view(f"V{LENGTH}").ravel().tolist()
                    h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, text)), "<i8").reshape(-1, 2)
                    columns = [h[:, 0], h[:, 1], own["null"] != 0, own["id"], own["uid"], own["pos"] - k]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["h1", "h2", "null", "id", "uid", "start"])

    found = around.mapInArrow(lean_batches(rows), "h1 long, h2 long, null boolean, id long, uid long, start int")
    return found.select("h1", "h2", F.struct("null", "id", "uid", "start").alias("at"))


def spans_of_windows(around: DataFrame, places: int) -> DataFrame:
    """(part, rows): spans of the windows that also start earlier, without a group that one task must hold."""
    first = windows(around).groupBy("h1", "h2").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last")
    first = written(first.select("h1", "h2", "first"), "first-windows")
    later = windows(around).join(first, ["h1", "h2"]).where("at > first").select("at.uid", "at.start")

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, SPAN)
            found["uid"], found["start"] = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found["end"] = found["start"] + LENGTH
            out = list(zip(*spans_by_part(found, places), strict=True))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary())], names=["part", "rows"])

    return later.mapInArrow(spans, "part int, rows binary")


def united(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Spans of one part's documents without overlaps."""
    spans = np.frombuffer(b"".join(group["rows"]), SPAN)
    spans = merged(spans)
    out = []
    for a, n in zip(*runs(spans["uid"]), strict=True):
        own = spans[a : a + n]
        out.append((int(own["uid"][0]), int((own["end"] - own["start"]).sum()), n, own["start"].tolist(), own["end"].tolist()))
    return pd.DataFrame(out, columns=["uid", "n_removed", "n_spans", "starts", "ends"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, sha, is_first, n, n_removed, n_spans, starts, ends): one row per document, with the spans to remove (null: none or all)."""
    docs = settled(docs.select("doc_id", "text"), "documents")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // TEXT_A_PARTITION))
    found = anchor_blocks(docs, parts).groupBy("part").applyInPandas(lean_group(lambda k, g: repeated_anchors(k, g, parts)), FOUND)
    found = written(found, "anchors")
    own = found.where("kind = 0").select("uid", "doc_id", "n", "sha")
    first = own.groupBy("sha").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "uid"))["uid"].alias("first"))
    own = written(own.join(first, "sha").select("uid", "doc_id", "n", "sha", (F.col("uid") == F.col("first")).alias("is_first")), "texts")
    places = found.where("kind = 1").select("part", "docs", "counts", "places").groupBy("part").applyInPandas(lean_group(places_of_docs), "uid long, places binary, n_places long")
    marks = written(places.join(own.where("is_first").select("uid", "doc_id", "sha"), "uid"), "marks")
    sent = (marks.agg(F.sum("n_places")).first()[0] or 0) * (LEFT + LENGTH)
    text = docs.select(F.col("doc_id").cast("long").alias("id"), "text").withColumn("text_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    text = likely(text, marks.select(F.col("sha").alias("key")), F.col("text_sha"))
    marked = text.join(marks, text["id"].eqNullSafe(marks["doc_id"]) & (text["text_sha"] == marks["sha"]))
    around = written(surrounding_blocks(marked, max(1, -(-sent // SENT_A_PARTITION)), parts), "surroundings")
    hot = around.where("part >= 0").groupBy("part").agg(F.sum(F.octet_length("rows")).alias("bytes"))
    hot = written(hot.where(F.col("bytes") > HOT_PLACES * AROUND.itemsize).select("part"), "hot-parts")
    none_hot = hot.isEmpty()
    few = around if none_hot else around.join(hot, "part", "left_anti")
    spans = few.groupBy("part").applyInPandas(lean_group(lambda k, g: spans_of_part(k, g, parts)), "part int, rows binary")
    if not none_hot:
        spans = spans.unionByName(spans_of_windows(around.join(hot, "part", "left_semi").select("part", "rows", "bytes"), parts))
    spans = spans.groupBy("part").applyInPandas(lean_group(united), "uid long, n_removed long, n_spans long, starts array<int>, ends array<int>")
    spans = written(spans, "spans")
    copy = ~F.col("is_first") & (F.col("n") >= LENGTH)
    return own.join(spans, "uid", "left").select(
        "doc_id", "sha", "is_first", "n",
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"), "starts", "ends",
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary): documents with what is left of their text, null where that is the whole text.

    A text without spans isn't moved; a text that is removed whole is empty.
    """
    spans = written(repeated_spans(docs), "repeated")
    some = written(spans.where("n_removed > 0 AND n_removed < n").dropDuplicates(["doc_id", "sha"]), "cut-texts")
    text = docs.select(F.col("doc_id").cast("long").alias("id"), "text").withColumn("text_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    text = likely(text, some.select(F.col("sha").alias("key")), F.col("text_sha"))
    both = text.join(some, text["id"].eqNullSafe(some["doc_id"]) & (text["text_sha"] == some["sha"])).dropDuplicates(["doc_id", "sha"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, starts, ends in zip(texts(batch.column(5)), batch.column(6).to_pylist(), batch.column(7).to_pylist(), strict=True):
                out.append(b"".join(raw[a:b] for a, b in zip([0, *ends], [*starts, len(raw)], strict=True)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out, pa.binary())], names=["doc_id", "sha", "n_bytes", "n_removed", "n_spans", "kept"])

    n = F.col("n").alias("n_bytes")
    left = both.select("doc_id", "sha", n, "n_removed", "n_spans", "text", "starts", "ends").mapInArrow(
        lean_batches(cut), "doc_id long, sha string, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    whole = spans.where("n_removed = 0 OR n_removed = n")
    empty = F.when(F.col("n_removed") > 0, F.lit(b"")).alias("kept")
    return left.unionByName(whole.select("doc_id", "sha", n, "n_removed", "n_spans", empty))


def op4_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with all their columns and what is left of their texts; documents with nothing left go.

    Of rows with equal ids and texts one stays if the text's first occurrence is among them, cut like it. Bytes of a
    character that is removed in part go with it.
    """
    found = written(repeated_spans(docs), "repeated")
    gone = found.where("n_removed > 0")
    # a first row without spans matters if rows equal to it go
    copies = written(gone.where("NOT is_first").select(F.col("sha").alias("key")).distinct(), "copied-texts")
    whole_first = likely(found.where((F.col("n") >= LENGTH) & F.expr("is_first AND n_removed = 0")), copies, F.col("sha"))
    first = F.max(F.when(F.col("is_first"), F.struct("n_removed", "starts", "ends"))).alias("first")
    spans = gone.unionByName(whole_first).groupBy("doc_id", "sha").agg(F.max("n").cast("int").alias("n"), F.count(F.lit(1)).alias("rows"), first)
    all_gone = F.col("first").isNull() | (F.col("first.n_removed") == F.col("n"))
    spans = spans.select(
        F.col("doc_id").alias("key"), F.col("sha").alias("key_sha"), (~all_gone & (F.col("rows") > 1)).alias("repeated"),
        F.when(all_gone, F.array(F.lit(0))).otherwise(F.col("first.starts")).alias("starts"), F.when(all_gone, F.array("n")).otherwise(F.col("first.ends")).alias("ends"),
    )
    spans = written(spans.where("repeated OR starts IS NOT NULL"), "spans-of-rows")
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    names = docs.columns
    packed = docs.select("doc_id", F.struct(*quoted(names)).alias("row"), sha.alias("text_sha"))
    both = packed.join(spans, packed["doc_id"].cast("long").eqNullSafe(spans["key"]) & (packed["text_sha"] == spans["key_sha"]), "left")
    both = both.select("row", "key", "key_sha", "repeated", "starts", "ends")
    if not spans.where("repeated").isEmpty():
        once = both.where("repeated").dropDuplicates(["key", "key_sha"])
        both = both.where("repeated IS NULL OR NOT repeated").unionByName(once)
    # inside, columns go by numbers, so any names will do
    wide = both.select(*[F.col("row")[n].alias(f"c{k}") for k, n in enumerate(names)], "starts", "ends")
    plain = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)])
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, keep = [], []
            for text, starts, ends in zip(batch.column(at), batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True):
                text = text.as_py()
                if starts:
                    raw = text.encode("utf-8")
                    text = b"".join(raw[a:b] for a, b in zip([0, *ends], [*starts, len(raw)], strict=True)).decode("utf-8", "ignore")
                out.append(text)
                keep.append(not starts or bool(text))
            columns = [pa.array(out, pa.string()) if k == at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=plain.names).filter(pa.array(keep, pa.bool_()))

    return wide.mapInArrow(lean_batches(cut), plain).toDF(*names)
