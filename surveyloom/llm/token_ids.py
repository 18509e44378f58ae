"""Token ids of whole texts in the vocabulary of the public byte-level tokenizer.

The `tokenizers` library defines the ids. Texts of common letters and marks go
through `tiktoken`, which holds the same vocabulary and is several times
faster; texts with any other character, or with the string of a special
token, go through `tokenizers` itself, so differences between the libraries'
character tables can't matter.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers

VOCABULARY = "byte_bpe_50k"
#: ASCII, Latin letters, common dashes, quotation marks and the euro sign.
COMMON = re.compile("[\\x00-\\x1b\\x20-\\x84\\x86-\\x9f\\xa1-\\u024f\\u2013\\u2014\\u2018-\\u201f\\u2026\\u20ac]*", re.ASCII)
END_OF_DOCUMENT = 2


@lru_cache(1)
def encoders():
    import tiktoken

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(VOCABULARY + ".json"))
    exact.no_truncation()
    exact.no_padding()
    with open(public_tokenizers.path(VOCABULARY + ".tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(VOCABULARY, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [x.content for x in exact.get_added_tokens_decoder().values()]
    return exact, fast, special


def text_ids(text: str | None) -> np.ndarray:
    """Ids of a whole text as the `tokenizers` library gives them; a null text is empty."""
    if not text:
        return np.empty(0, np.uint32)
    exact, fast, special = encoders()
    if COMMON.fullmatch(text) and not any(s in text for s in special):
        return fast.encode_to_numpy(text, disallowed_special=())
    return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)


def document_ids(text: str | None) -> np.ndarray:
    """``text_ids`` and the mark that ends a document."""
    return np.append(text_ids(text), np.uint32(END_OF_DOCUMENT)).astype("<u4")


def cut(n: int, width: int) -> Iterator[tuple[int, int]]:
    """(start, length) of pieces of at most ``width`` that cover ``n`` ids; only the first may be shorter if there are several."""
    at = 0
    while at < n:
        size = (n % width or width) if at == 0 and n > width else min(width, n - at)
        yield at, size
        at += size


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
