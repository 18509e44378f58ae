"""Exact byte-pair encoding by dynamic programming over prefixes.

The encoding of a prefix has one last token, and that token together with the
encoding of what stands before it is the encoding of the prefix. So for every
prefix it is enough to store the last token: among the vocabulary entries that
end there (found by an automaton over the vocabulary), it is the one that is
compatible with the stored last token before it. Following the stored tokens
back from the end gives the ids.

Two tokens are compatible if no merge across their border would have happened
before the tokens themselves were complete; undoing merges from the latest to
the earliest on both sides tells.

Edge cases: a null text is empty and has no ids; empty tables give empty
results; repeated rows are encoded row by row; only the id and text columns
are read. Texts of any length are encoded whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.tables import table

#: Longer pieces are encoded without being remembered; the memory is emptied when full.
CACHED_CHARS, CACHED_PIECES = 40, 400_000
#: Ids that the encoder and rows that the decoder hand over at once.
BATCH_IDS, BATCH_ROWS = 1 << 19, 1000


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: letter -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pieces(dict):
    """Piece of text -> its ids, encoded when first asked for."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.encode(piece.encode("utf-8")))
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class BytePairCodec:
    """Encoder and decoder of a byte-level BPE vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = {i: bytes(letters[c] for c in s) for s, i in vocab.items() if s not in self.special}
        self.bytes_of |= {i: s.encode("utf-8") for s, i in self.special.items()}
        # Ranks: single bytes come before all merges, merges in their order.
        self.rank, self.made_by, self.joined = {}, {}, {}
        singles = sorted(vocab[c] for c in letters)
        self.rank.update({i: k - len(singles) for k, i in enumerate(singles)})
        for k, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.joined[left, right] = k
            if whole not in self.rank:
                self.rank[whole], self.made_by[whole] = k, (left, right)
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.compatible = lru_cache(1 << 17)(self._compatible)
        self.pieces = Pieces(self.encode_piece)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds the vocabulary entries that end at each place, longest first; only the encoder needs it."""
        found = ahocorasick.Automaton()
        for i in self.rank:
            raw = self.bytes_of[i]
            found.add_word(raw.decode("latin-1"), (i, len(raw)))
        found.make_automaton()
        return found

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the encoding keeps ``left`` and ``right`` apart when they stand side by side."""
        before = 1 << 60  # merges of a lower rank than this have happened at the border by now
        while True:
            merge = self.joined.get((left, right))
            if merge is not None and merge < before:
                return False
            # Undo the later of the two merges that made the sides; of equal ones the right one is later.
            if (right in self.made_by and self.rank[right] >= self.rank[left]) or left not in self.made_by:
                if right not in self.made_by:
                    return True
                # At the same rank the border's merge comes first, being further left.
                before, right = self.rank[right] + 1, self.made_by[right][0]
            else:
                before, left = self.rank[left], self.made_by[left][1]

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one piece by the per-prefix table."""
        last: list[tuple[int, int] | None] = [None] * len(raw)
        for end, (token, size) in self.automaton.iter(raw.decode("latin-1")):
            if last[end] is None:
                start = end - size
                if start < 0 or last[start] is not None and self.compatible(last[start][0], token):
                    last[end] = token, size
        ids, at = [], len(raw) - 1
        while at >= 0:
            token, size = last[at]
            ids.append(token)
            at -= size
        return ids[::-1]

    def encode(self, text: str) -> list[int]:
        return list(self.iter_ids(text))

    def iter_ids(self, text: str) -> Iterator[int]:
        find = self.pieces.__getitem__
        if self.split_special is None or not any(s in text for s in self.special):
            return chain.from_iterable(map(find, self.split.findall(text)))
        parts = self.split_special.split(text)
        return chain.from_iterable(
            (self.special[x],) if x in self.special else chain.from_iterable(map(find, self.split.findall(x))) for x in parts
        )

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def codec(path: str) -> BytePairCodec:
    return BytePairCodec(path)


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of whole texts. No shuffle."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = codec(path)

        def out() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), lists], names=["doc_id", "ids"])

        keys, ids, held = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(key)
                ids.append(np.fromiter(found.iter_ids(text.as_py() or ""), np.int32))
                held += len(ids[-1])
                if held >= BATCH_IDS:
                    yield out()
                    keys, ids, held = [], [], 0
        if keys:
            yield out()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the column ``text`` decoded from ``ids``; special tokens are kept."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = codec(path)
        for batch in (x.slice(k, BATCH_ROWS) for x in batches for k in range(0, x.num_rows, BATCH_ROWS)):
            flat, ends = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            texts = [found.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids array<int>, text string")


def op7_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    both = bpe_decode(bpe_encode(table(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
