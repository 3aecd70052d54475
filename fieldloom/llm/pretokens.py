"""Splitting text into the pre-tokens of the byte-level vocabularies, for whole Arrow batches at once.

The pattern (contractions; letters, digits or other signs with at most one blank before; blanks) is evaluated with array
operations on code points: classes change at run boundaries, the last blank of a run joins what follows, and
contractions are cut from the letters after an apostrophe.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex

LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
_SHORT, _LONG = tuple(map(ord, "stmd")), (("r", "e"), ("v", "e"), ("l", "l"))


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    points = np.frombuffer(every.encode("utf-32-le"), np.uint32)
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[points[m.start() : m.end()]] = kind
    return out


class Words(NamedTuple):
    """Pre-tokens of a batch of texts. data: UTF-8 bytes; edges: byte offsets, n + 1; first: index of each text's first word, texts + 1."""

    data: np.ndarray
    edges: np.ndarray
    first: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.edges[i] : self.edges[i + 1]].tobytes()


def _utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array without nulls."""
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and len(offsets) else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def split(texts: pa.Array) -> Words:
    """The words of each text; an empty or null one has none."""
    texts = texts.fill_null("")
    data, offsets = _utf8(texts)
    n = len(data)
    if not n:
        return Words(data, np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64))
    lead = (data & 0xC0) != 0x80
    if lead.all():
        at, points = None, data
        kind = classes()[:128][data]
        starts = offsets[:-1]
    else:
        at = np.flatnonzero(lead)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = classes()[points]
        starts = np.searchsorted(at, offsets[:-1])
    m = len(points)
    opens = np.zeros(m + 1, bool)
    opens[starts] = True  # texts begin, empty ones at the end included
    opens[m] = True
    run = opens.copy()
    run[1:m] |= kind[1:] != kind[:-1]
    begin = run.copy()
    space = kind == SPACE
    # the last blank of a run that something of the same text follows
    last = space & run[1:] & ~opens[1:]
    begin[:m] |= last
    joins = np.flatnonzero(last & (points == 32)) + 1
    begin[joins] = False
    quote = np.flatnonzero(points == 39)
    if len(quote):
        quote = quote[begin[quote]]
        limit = m - 1
        one, two = np.minimum(quote + 1, limit), np.minimum(quote + 2, limit)
        follows = (quote + 1 < m) & ~opens[quote + 1]
        short = follows & np.isin(points[one], _SHORT)
        third = (quote + 2 < m) & ~opens[np.minimum(quote + 2, m)]
        pair = np.zeros(len(quote), bool)
        for x, y in _LONG:
            pair |= (points[one] == ord(x)) & (points[two] == ord(y))
        pair &= follows & third
        begin[quote[short | pair] + 1] = False
        begin[quote[short] + 2] = True
        begin[quote[pair] + 3] = True
    words = np.flatnonzero(begin)
    edges = words if at is None else np.append(at, n)[words]
    first = np.searchsorted(edges, offsets)
    return Words(data, edges.astype(np.int64), first.astype(np.int64))
