"""Cutting documents beyond a token limit into ordered, overlapping pieces at natural boundaries.

For n tokens, the least number of pieces follows from limit and overlap; their ends get equally spaced targets; each is
snapped to the strongest boundary near it that keeps all limits; and where a limit fails, a piece is added and all
targets are set anew.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .encoder import Coder, Encoder, blocks
from .lexicon import ranks
from .pretokens import Words, split

#: Marks that end a sentence or a clause, and those that may close a quotation after them.
SENTENCE, WIDE_SENTENCE, CLAUSE, CLOSING = ".!?…", "。！？؟।", ",;:，、；：،", "\"')]}”’»"
#: Strength of a boundary: inside a word, between words, at a blank, after a clause, a sentence, a line, a paragraph.
INSIDE, WORD, BLANK, AFTER_CLAUSE, AFTER_SENTENCE, LINE, PARAGRAPH = range(-1, 6)
#: Words of more tokens than this may be cut inside, between characters.
LONG_WORD = 32
#: How far from its target an end may be moved, as a share of the pieces' length.
REACH = 0.25
#: So many pieces are added one by one where a limit fails; after that their number grows faster.
STEADY = 4


def _last3(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The three bytes before each place as one number."""
    b = lambda k: np.where(at >= k, data[np.maximum(at - k, 0)], 0).astype(np.int64)
    return b(3) << 16 | b(2) << 8 | b(1)


def _ends_with(last3: np.ndarray, chars: str) -> np.ndarray:
    out = np.zeros(len(last3), bool)
    for c in chars:
        e = c.encode()
        out |= (last3 & ((1 << 8 * len(e)) - 1)) == int.from_bytes(e, "big")
    return out


def strengths(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How strong a boundary each word edge is."""
    before = _last3(data, edges)
    after = np.where(edges < len(data), data[np.minimum(edges, len(data) - 1)], 32)
    gap = (after == 32) | (after == 10) | (after == 13) | (after == 9)
    closed = _ends_with(before, CLOSING[:5])
    inner = np.where(closed, before >> 8, before)
    out = np.where(gap, BLANK, WORD).astype(np.int8)
    out[gap & _ends_with(before, CLAUSE) | _ends_with(before, "，、；：")] = AFTER_CLAUSE
    out[gap & _ends_with(inner, SENTENCE + WIDE_SENTENCE) | _ends_with(before, "。！？")] = AFTER_SENTENCE
    line = (before & 0xFF) == 10
    out[line] = LINE
    out[line & (((before >> 8 & 0xFF) == 10) | (before == 0x0A0D0A))] = PARAGRAPH
    return out


@lru_cache(4)
def _lengths(vocabulary: str) -> np.ndarray:
    """Bytes of each token."""
    r = ranks(vocabulary)
    out = np.zeros(max(r.values()) + 1, np.int64)
    for w, i in r.items():
        out[i] = len(w)
    return out


def units(data: np.ndarray, edges: np.ndarray, counts: np.ndarray, ids: np.ndarray, vocabulary: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, tokens before, strength) of a text's possible cuts, its start and end included: word edges, and in long words the token ends between characters."""
    before = np.concatenate([[0], np.cumsum(counts)])
    places, tokens, strong = edges, before, strengths(data, edges)
    extra = []
    for w in np.flatnonzero(counts > LONG_WORD):
        ends = edges[w] + np.cumsum(_lengths(vocabulary)[ids[before[w] : before[w + 1]]])[:-1]
        good = np.flatnonzero((data[ends] & 0xC0) != 0x80)
        extra.append((ends[good], before[w] + 1 + good))
    if extra:
        more, at = (np.concatenate(x) for x in zip(*extra))
        places, tokens, strong = np.concatenate([places, more]), np.concatenate([tokens, at]), np.concatenate([strong, np.full(len(more), INSIDE, np.int8)])
        order = np.argsort(places, kind="stable")
        places, tokens, strong = places[order], tokens[order], strong[order]
    return places, tokens, strong


def cut(tokens: np.ndarray, strong: np.ndarray, limit: int, overlap: int, extra: int = 0) -> list[tuple[int, int]] | None:
    """Pieces as (first, last) indices of cuts, at equal targets snapped to the strongest cut near them; None if so few pieces can't hold the limit.

    tokens: before each cut, ascending from 0. ``extra`` pieces are added to the least number. Each piece after the
    first begins at the last cut that has at least ``overlap`` tokens before the end of the piece before it.
    """
    n = int(tokens[-1])
    if n <= limit and not extra:
        return [(0, len(tokens) - 1)]
    many = (1 if n <= limit else 1 + -(-(n - limit) // (limit - overlap))) + extra
    length = (n + (many - 1) * overlap) / many
    out, start = [], 0
    for i in range(many - 1):
        target = length + i * (length - overlap)
        left = many - 1 - i
        # the end must leave no more than the pieces to come can hold, and the next piece must begin after this one
        low = max(n - left * (limit - overlap), tokens[start] + overlap + 1)
        high = min(tokens[start] + limit, n - 1)
        a, b = np.searchsorted(tokens, (max(low, target - REACH * length), min(high, target + REACH * length) + 1e-9))
        if b <= a:  # none near the target: the nearest one that holds the limit
            a = int(np.searchsorted(tokens, tokens[start] + overlap, "right"))
            b = int(np.searchsorted(tokens, high, "right"))
            if b <= a:
                return None
            end = b - 1
        else:
            near = strong[a:b] - np.abs(tokens[a:b] - target) / (2 * REACH * length)
            end = a + int(near.argmax())
        out.append((start, end))
        back = int(np.searchsorted(tokens, tokens[end] - overlap, "right")) - 1
        while back > start and tokens[back] == tokens[back - 1]:
            back -= 1
        if back <= start:
            return None
        start = back
    out.append((start, len(tokens) - 1))
    return out if tokens[-1] - tokens[start] <= limit else None


#: ASCII blanks, and the last bytes of others.
_BLANKS, _WIDE_BLANKS = b" \t\n\r\x0b\x0c", b"\x80\x81\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x9f\xa0\xa8\xa9\xaf"


def _alone(body: bytes, edges: np.ndarray, before: np.ndarray, s: int, e: int, n: int, coder: Coder) -> int:
    """Tokens of body[s:e], cut at word edges, when it stands alone; ``n`` in the text.

    Only a run of blanks at the end reads otherwise then: as one word.
    """
    if e == len(body) or body[e - 1] not in _BLANKS + _WIDE_BLANKS:
        return n
    tail = body[s:e]
    run = len(tail) - len(tail.rstrip(_BLANKS))
    k = int(np.searchsorted(edges, e - run))
    if tail[len(tail) - run - 1 : len(tail) - run] in [bytes([b]) for b in _WIDE_BLANKS] or edges[k] != e - run:
        return _count(tail, coder)
    if run < 2:
        return n
    return n - int(before[np.searchsorted(edges, e)] - before[k]) + len(coder.ids(body[e - run : e]))


def _count(piece: bytes, coder: Coder) -> int:
    return int(coder.encode(split(pa.array([piece.decode("utf-8")])))[0].sum())


def pieces(
    text: np.ndarray, edges: np.ndarray, counts: np.ndarray, ids: np.ndarray, coder: Coder, limit: int, overlap: int
) -> list[tuple[int, int, int]]:
    """(start byte, end byte, tokens) of a text's pieces, tokens as counted in the piece alone.

    Raises ValueError if the limit is below the tokens of a character and the overlap.
    """
    n = int(counts.sum())
    if n <= limit:
        return [(0, len(text), n)]
    places, tokens, strong = units(text, edges, counts, ids, coder.vocabulary)
    body, before, inside = text.tobytes(), np.concatenate([[0], np.cumsum(counts)]), strong == INSIDE

    def tried(extra: int) -> list[tuple[int, int, int]] | None:
        out = []
        for a, b in cut(tokens, strong, limit, overlap, extra) or ():
            s, e, m = int(places[a]), int(places[b]), int(tokens[b] - tokens[a])
            m = _count(body[s:e], coder) if inside[a] or inside[b] else _alone(body, edges, before, s, e, m, coder)
            if m > limit:
                return None
            out.append((s, e, m))
        return out or None

    # a piece more each time at first, then twice as many, and back by halves: a bad text takes log n rounds, not n
    failed, extra, out = -1, 0, None
    while out is None and extra < n:
        out = tried(extra)
        if out is None:
            failed, extra = extra, extra + max(1, extra - STEADY)
    while out is not None and extra - failed > 1:
        middle = (failed + extra) // 2
        fewer = tried(middle)
        failed, extra, out = (failed, middle, fewer) if fewer else (middle, extra, out)
    if out is None:
        raise ValueError("the limit is too small for a character and the overlap")
    return out


def split_documents(docs: DataFrame, key: str, text: str, encoder: Encoder, limit: int, overlap: int, with_text: bool = True) -> DataFrame:
    """(key, piece_no, n_pieces, start_char, end_char, n_tokens, text): the pieces of each text, in order.

    No piece has more than ``limit`` tokens, counted in the piece alone; consecutive ones share at least ``overlap``
    tokens, and no more than the word (or, in long words, the character) there adds; all together cover the text. A
    text within the limit is one piece, and so is an empty or null one, with its text as it is. Null keys and rows that
    stand twice come out as they are.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be below the limit")
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            coder = coder or Coder(encoder)
            at = 0
            for part in blocks(batch.column(1)):
                w: Words = split(part)
                counts, ids = coder.encode(w)
                ends = np.concatenate([[0], np.cumsum(counts)])
                total = np.diff(ends[w.first])
                long = total > limit
                rows = []
                chars = np.asarray(pa.compute.fill_null(pa.compute.utf8_length(part), 0))
                texts: list[str | None] = []
                for i in range(len(part)) if with_text or long.any() else ():
                    if long[i]:
                        a, b = int(w.first[i]), int(w.first[i + 1])
                        s = w.edges[a]
                        body = w.data[s : w.edges[b]]
                        own = pieces(body, w.edges[a : b + 1] - s, counts[a:b], ids[ends[a] : ends[b]], coder, limit, overlap)
                        lead = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
                        rows += [(i, k, len(own), int(lead[x]), int(lead[y]), m) for k, (x, y, m) in enumerate(own)]
                        if with_text:
                            texts += [body[x:y].tobytes().decode("utf-8") for x, y, _ in own]
                    elif with_text:
                        rows.append((i, 0, 1, 0, int(chars[i]), int(total[i])))
                        texts.append(part[i].as_py())
                if not with_text:
                    rest = np.flatnonzero(~long)
                    rows += zip(rest.tolist(), [0] * len(rest), [1] * len(rest), [0] * len(rest), chars[rest].tolist(), total[rest].tolist())
                cols = list(zip(*rows)) or [()] * 6
                take = pa.array(cols[0], pa.int64())
                own_keys = batch.column(0).slice(at, len(part)).take(take)
                arrays = [
                    own_keys, *[pa.array(c, t) for c, t in zip(cols[1:], [pa.int32()] * 2 + [pa.int64()] * 3)]
                ] + ([pa.array(texts, pa.string())] if with_text else [])
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["key", "piece_no", "n_pieces", "start_char", "end_char", "n_tokens"] + ["text"] * with_text
                )
                at += len(part)

    shape = f"key {kind}, piece_no int, n_pieces int, start_char bigint, end_char bigint, n_tokens bigint" + ", text string" * with_text
    return spread(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))).mapInArrow(run, shape).withColumnRenamed("key", key)
