"""A minimal acyclic transducer from words to token ids, as flat arrays that are mapped into memory.

Words share prefixes and suffixes: equal right languages are one state. Outputs ride on the transitions as counts of the
words before, whose sum is a word's number (a minimal perfect hash), and the number leads to its ids. Transitions lie in
a double array, so a step is four array reads, taken for all words of a batch at once.
"""

from __future__ import annotations

import base64
import importlib.util
import io
import os
import struct
from functools import lru_cache

import numpy as np
import tiktoken

#: Set to the folder of the vocabulary files, or left to the installed package of them.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS_DIR", "")
#: Fixed value: the vocabularies' pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "byte_bpe_50k"
_NAMES = ("base", "check", "target", "skip", "final", "offsets", "ids")


def vocabulary_path(name: str = VOCABULARY, folder: str | None = None) -> str:
    folder = folder or TOKENIZERS
    if not folder:
        found = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(found.origin) if found else "/opt/tokenizers"
    return os.path.join(folder, f"{name}.tiktoken")


@lru_cache(4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(4)
def merger(path: str) -> tiktoken.Encoding:
    """Byte-pair merging of single words."""
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


def merge(word: bytes, path: str) -> list[int]:
    """The ids of one pre-token by exact merging."""
    own = ranks(path).get(word)
    return [own] if own is not None else merger(path)._core_bpe.encode_single_piece(word)


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The transducer of ``words`` (none empty) as one block of arrays."""
    order = sorted(w for w in words if w)
    # states: tuples of (byte, target) and finality; a register holds one of each
    register: dict[tuple, int] = {}
    final, edges, count = [], [], []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        s = register.get(key)
        if s is None:
            s = register[key] = len(final)
            final.append(node[0])
            edges.append(key[1])
            count.append(node[0] + sum(count[t] for _, t in key[1]))
        return s

    path: list[list] = [[False, []]]
    before = b""
    for w in order:
        k = len(os.path.commonprefix((before, w)))
        while len(path) - 1 > k:
            s = freeze(path.pop())
            path[-1][1][-1] = (path[-1][1][-1], s)
        for b in w[k:]:
            path[-1][1].append(b)
            path.append([False, []])
        path[-1][0] = True
        before = w
    while len(path) > 1:
        s = freeze(path.pop())
        path[-1][1][-1] = (path[-1][1][-1], s)
    root = freeze(path[0])

    # double array: the edges of a state lie at base + byte
    size = sum(map(len, edges)) * 2 + 1024
    check, target, skip = np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int32)
    base = np.zeros(len(final), np.int32)
    used = bytearray(size)
    low = 0
    for s in sorted(range(len(edges)), key=lambda s: -len(edges[s])):
        own = edges[s]
        if not own:
            continue
        bytes_ = [b for b, _ in own]
        at = used.find(0, low)
        tries = 0
        while at < bytes_[0] or any(used[at - bytes_[0] + b] for b in bytes_[1:]):
            at = used.find(0, at + 1)
            tries += 1
            if at + 512 > len(used) or at < 0:
                at = len(used) if at < 0 else at
                used.extend(bytes(max(4096, len(used) // 4)))
        if tries > 64:
            low = min(at, used.find(0, low + (at - low) // 4))
        start = at - bytes_[0]
        base[s] = start
        if start + 256 > len(check):
            grow = max(len(used) - len(check), 4096) + 256
            check, target, skip = np.append(check, np.full(grow, -1, np.int32)), np.append(target, np.zeros(grow, np.int32)), np.append(skip, np.zeros(grow, np.int32))
        words_before = int(final[s])
        for b, t in own:
            used[start + b] = 1
            check[start + b], target[start + b], skip[start + b] = s, t, words_before
            words_before += count[t]
    end = int(base.max(initial=0)) + 256
    pad = max(0, end - len(check))
    check, target, skip = (np.append(x, np.full(pad, v, np.int32))[:end] for x, v in ((check, -1), (target, 0), (skip, 0)))
    lengths = [len(words[w]) for w in order]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    ids = np.fromiter((i for w in order for i in words[w]), np.int32, int(offsets[-1]))
    arrays = dict(zip(_NAMES, (base, check, target, skip, np.array(final, np.int32), offsets, ids)))
    out = io.BytesIO()
    out.write(struct.pack(f"<{len(_NAMES) + 2}q", root, max(map(len, order), default=0), *[len(arrays[n]) for n in _NAMES]))
    for n in _NAMES:
        out.write(arrays[n].tobytes())
    return out.getvalue()


class Lexicon:
    """A compiled transducer, from a file mapped into memory or from its bytes."""

    def __init__(self, source: str | bytes):
        raw = np.memmap(source, np.uint8, "r") if isinstance(source, str) else np.frombuffer(source, np.uint8)
        head = struct.unpack_from(f"<{len(_NAMES) + 2}q", raw[: 8 * (len(_NAMES) + 2)].tobytes())
        self.root, self.longest = head[:2]
        at = 8 * len(head)
        for name, n in zip(_NAMES, head[2:]):
            setattr(self, name, raw[at : at + 4 * n].view(np.int32))
            at += 4 * n

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word data[start:end], -1 for those the lexicon lacks."""
        out = np.full(len(starts), -1, np.int32)
        live = np.flatnonzero((ends - starts <= self.longest) & (ends > starts))
        at, left = starts[live], (ends - starts)[live]
        state, total = np.full(len(live), self.root, np.int32), np.zeros(len(live), np.int32)
        while len(live):
            slot = self.base[state] + data[at]
            keep = np.flatnonzero(self.check[slot] == state)
            if len(keep) < len(live):
                live, at, left, total, slot = live[keep], at[keep], left[keep], total[keep], slot[keep]
            state, total = self.target[slot], total + self.skip[slot]
            at, left = at + 1, left - 1
            over = left == 0
            if over.any():
                good = over & (self.final[state] > 0)
                out[live[good]] = total[good]
                on = np.flatnonzero(~over)
                live, at, left, total, state = live[on], at[on], left[on], total[on], state[on]
        return out
