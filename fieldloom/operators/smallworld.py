"""Navigable small-world graphs over page codes, with a beam that is tuned against exhaustive search.

A code of ten letters and digits is a number of ten digits to the base 36. Two orders of its halves give two metrics:
the difference of the numbers with the first half leading, and with the last half leading. Codes that differ in one place
share a half, so in one of the two metrics all codes that share it lie side by side. (Over Hamming distance itself a graph
can't be navigated here: random codes nearly all lie 9 or 10 places apart, so distances give a search no direction.)

A graph is hierarchical: each node is drawn into layers by chance, a quarter of a layer's nodes into the next one up,
and is linked in each of its layers to the nodes nearest to it there, two on either side. Links of upper layers are the
long ones. A search goes greedily along the links from the one entry node, layer by layer, then spreads a beam over the
links of the base layer. The beam's width is chosen per graph, see ``tune``; it widens for queries whose neighbourhood
is denser. What the beam reaches is reranked exactly, by the places in which codes differ.
"""

from __future__ import annotations

import numpy as np

from ..functions.links import CODE_LENGTH

#: Codes of half a length; a key is its leading half times this plus its other half.
HALF_CODES = 36 ** (CODE_LENGTH // 2)
#: One node in so many of a layer is in the next one up.
FAN_OUT = 4
#: Links of a node in a layer to either side.
SIDE = 2
#: Queries that a graph's beam is tuned with, the widths tried, and the share of neighbours that the beam must find unwidened.
TUNE_QUERIES, BEAMS, RECALL = 64, (1, 2, 4, 8, 16), 0.99


def turn(keys: np.ndarray) -> np.ndarray:
    """Keys with their other half leading, and back."""
    return keys % HALF_CODES * HALF_CODES + keys // HALF_CODES


def places_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many places the last halves of two keys differ."""
    a, b = a % HALF_CODES, b % HALF_CODES
    out = np.zeros(len(a), np.int8)
    for _ in range(CODE_LENGTH // 2):
        out += a % 36 != b % 36
        a, b = a // 36, b // 36
    return out


def _slots(halves: np.ndarray, bits: int) -> np.ndarray:
    """A place of each half in a table of so many bits; another hash than the one that halves are routed by."""
    return (halves.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def _layers(keys: np.ndarray) -> np.ndarray:
    """The highest layer of each node: geometric, drawn from a hash of its key, so that a graph is the same whenever it is built."""
    x = keys.astype(np.uint64)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    x ^= x >> np.uint64(31)
    top = max(0, int(np.ceil(np.log(max(len(keys), 1)) / np.log(FAN_OUT))) - 1)
    out = np.zeros(len(keys), np.int8)
    for layer in range(1, top + 1):
        out[x % np.uint64(FAN_OUT**layer) == 0] = layer
    return out


class Graph:
    """keys: distinct, numbered by layer from the top; firsts: the first row of each page; links: of each layer, from the base up."""

    __slots__ = ("keys", "firsts", "links", "beam", "sampled", "near", "found")

    def __init__(self, keys: np.ndarray, firsts: np.ndarray, links: list[np.ndarray], beam: int = 1, sampled: int = 0, near: int = 0, found: int = 0):
        self.keys, self.firsts, self.links, self.beam = keys, firsts, links, beam
        #: How the beam was tuned: queries, their neighbours by exhaustive search, and those that the unwidened beam found.
        self.sampled, self.near, self.found = sampled, near, found

    def __len__(self) -> int:
        return len(self.keys)

    @classmethod
    def build(cls, keys: np.ndarray, firsts: np.ndarray) -> Graph:
        """Of equal keys the one with the least first row counts."""
        order = np.lexsort((firsts, keys))
        keys, firsts = keys[order], firsts[order]
        once = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
        keys, firsts = keys[once], firsts[once]
        layer = _layers(keys)
        number = np.argsort(-layer, kind="stable")
        keys, firsts, layer = keys[number], firsts[number], layer[number]
        along = np.argsort(keys, kind="stable").astype(np.int32)
        links = []
        for k in range(int(layer[0]) + 1 if len(layer) else 0):
            m = int(np.searchsorted(-layer, -k, "right"))
            links.append(_nearest(along[along < m]))
        out = cls(keys, firsts, links)
        out.tune()
        return out

    def nearest(self, queries: np.ndarray) -> np.ndarray:
        """Greedy search from the entry node: the node of each query that none of its links comes nearer than."""
        at = np.zeros(len(queries), np.int32)
        far = np.abs(self.keys[at] - queries)
        for links in reversed(self.links):
            live = np.arange(len(queries))
            while len(live):
                near = links[at[live]]
                apart = np.abs(self.keys[near] - queries[live, None])
                pick = apart.argmin(1)
                at_best = np.arange(len(live))
                best = apart[at_best, pick]
                on = best < far[live]
                live = live[on]
                at[live], far[live] = near[at_best[on], pick[on]], best[on]
        return at

    def search(self, queries: np.ndarray, beam: int | None = None, widen: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of the pairs found that share the leading half and differ in at most one place; all of them where the beam may widen."""
        if not len(self) or not len(queries):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        beam, base = self.beam if beam is None else beam, self.links[0]
        halves = queries // HALF_CODES
        seen_q, seen_n = [], []

        def see(q: np.ndarray, node: np.ndarray) -> None:
            share = self.keys[node] // HALF_CODES == halves[q]
            seen_q.append(q[share])
            seen_n.append(node[share])

        centre = self.nearest(queries)
        see(np.arange(len(queries)), centre)
        for side in (0, SIDE):
            live, at, step = np.arange(len(queries)), centre, 0
            while len(live):
                for k in range(side, side + SIDE):
                    to = base[at, k]
                    new = to != (at if k == side else base[at, k - 1])
                    see(live[new], to[new])
                end = base[at, side + SIDE - 1]
                step += 1
                on = end != at
                if step >= beam:  # as far as the beam goes; wider only where its edge still shares the half
                    on &= (self.keys[end] // HALF_CODES == halves[live]) if widen else False
                live, at = live[on], end[on]
        q, node = np.concatenate(seen_q), np.concatenate(seen_n)
        close = places_apart(queries[q], self.keys[node]) <= 1
        return q[close], node[close]

    def asked(self, queries: np.ndarray) -> np.ndarray:
        """Which of the queries the graph may have a neighbour of: all whose leading half is a node's, and few others.

        Told by a table of bits, 16 places a node, with the bits of the nodes' halves set; so a query costs a graph without its half next to nothing.
        """
        bits = len(self).bit_length() + 4
        table = np.zeros(1 << bits, bool)
        table[_slots(self.keys // HALF_CODES, bits)] = True
        return np.flatnonzero(table[_slots(queries // HALF_CODES, bits)])

    def exhaustive(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What ``search`` looks for, by comparing each query with every node."""
        q, node = np.nonzero((queries // HALF_CODES)[:, None] == (self.keys // HALF_CODES)[None])
        close = places_apart(queries[q], self.keys[node]) <= 1
        return q[close], node[close]

    def tune(self, queries: int = TUNE_QUERIES) -> None:
        """Sets the narrowest beam that finds RECALL of what exhaustive search finds for a bounded sample of queries.

        The queries are nodes spread over the graph, half of them mistyped in one place.
        """
        if not len(self):
            return
        own = self.keys[np.linspace(0, len(self) - 1, min(queries, len(self))).astype(np.int64)]
        slip = 36 ** (np.arange(len(own)) % (CODE_LENGTH // 2))
        digit = own // slip % 36
        own = np.where(np.arange(len(own)) % 2, own, own + ((digit + 7) % 36 - digit) * slip)
        want = len(self.exhaustive(own)[0])
        for beam in BEAMS:
            self.beam, self.sampled, self.near, self.found = beam, len(own), want, len(self.search(own, beam, False)[0])
            if self.found >= RECALL * want:
                return

    def pack(self) -> dict:
        """The graph as plain columns."""
        sizes = np.array([len(x) for x in self.links], np.int32)
        links = np.concatenate(self.links).astype(np.int32) if self.links else np.empty(0, np.int32)
        return {
            "nodes": len(self), "beam": self.beam, "sampled": self.sampled, "near": self.near, "found": self.found,
            "keys": self.keys.tobytes(), "firsts": self.firsts.tobytes(), "sizes": sizes.tobytes(), "links": links.tobytes(),
        }

    @classmethod
    def unpack(cls, row: dict) -> Graph:
        links = np.frombuffer(row["links"], np.int32).reshape(-1, 2 * SIDE)
        ends = np.cumsum(np.frombuffer(row["sizes"], np.int32))
        each = [links[b - n : b] for b, n in zip(ends, np.frombuffer(row["sizes"], np.int32))]
        return cls(
            np.frombuffer(row["keys"], np.int64), np.frombuffer(row["firsts"], np.int64), each, row["beam"], row["sampled"], row["near"],
            row["found"]
        )


def _nearest(along: np.ndarray) -> np.ndarray:
    """A layer's links: of each node the nearest SIDE on the left and on the right. Where there is none, the one before stands again, the node itself at first."""
    m = len(along)
    out = np.empty((m, 2 * SIDE), np.int32)
    at = np.arange(m)
    for k in range(1, SIDE + 1):
        out[along, k - 1] = along[np.maximum(at - k, 0)]
        out[along, SIDE + k - 1] = along[np.minimum(at + k, m - 1)]
    return out
