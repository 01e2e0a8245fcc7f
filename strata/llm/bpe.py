"""Byte-pair encoding as a path through a lattice of vocabulary pieces.

A token sequence is the encoding of its text exactly when every adjacent pair
of tokens is: no merge across the boundary may come before the merges that
built the two tokens. So the last token of the encoding of every prefix can be
found from left to right by trying the lattice edges that end there and
keeping the one compatible with its predecessor; the count at every prefix
follows. No merge list is replayed.

What a prefix passes on to longer ones is a *column*: the edges under way in it, each
with the token before it. Words share most of theirs, so a step from a column by a unit
is worked out once and looked up from then on (``Bpe.last_sizes``).

For each token the *spines* hold what lies at its borders while it is being
built: ``right[t]`` lists (suffix length, rank of the merge that swallows this
suffix), ``left[t]`` the same for prefixes; the whole token has rank ``TOP``.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterable, Sequence
from functools import lru_cache

TOP = 1 << 40
HEAD = 4                              # units by which pieces are looked up
SHORT = tuple(range(HEAD - 1, 0, -1))  # lengths to try where no longer piece begins
UNIT_BITS = 21                        # of a unit's number: a byte or a code point
KEPT_BYTES = 1 << 27                  # what the columns and steps kept by a worker may take, about
STEP_BYTES, COLUMN_BYTES = 100, 220   # of one in its dict; a column's edges come on top


class Bpe:
    """``tokens``: sequence units → id. ``pairs``: (left, right) → rank, or
    ``ranks``: token → rank when any split of a token may merge to it."""

    def __init__(self, tokens: dict, pairs: dict | None = None, ranks: dict | None = None, kept_bytes: int = KEPT_BYTES):
        self.tokens, self.pairs, self.ranks = tokens, pairs, ranks
        self.longest = max(map(len, tokens), default=1)
        self.left: dict = {}
        self.right: dict = {}
        split = self._splits()
        self.usable = set()
        for t in sorted(tokens, key=len):
            if len(t) == 1:
                self.left[t] = self.right[t] = ((1, TOP),)
                self.usable.add(t)
            elif (s := split.get(t)) and s[0] in self.usable and s[1] in self.usable:
                a, b = s
                rank = self._rank(a, b)
                left = ((len(t), TOP), (len(a), rank), *self.left[a][1:])
                right = ((len(t), TOP), (len(b), rank), *self.right[b][1:])
                if self._meets(a, b, True):
                    self.left[t], self.right[t] = left, right
                    self.usable.add(t)
        self.spans = {t: tokens[t] for t in self.usable}
        sizes: dict = {}
        for t in self.usable:
            if len(t) >= HEAD:
                sizes.setdefault(t[:HEAD], set()).add(len(t))
        #: first units → the lengths that pieces with this beginning have, longest first
        self.sizes = {k: (*sorted(v, reverse=True), *(n for n in range(HEAD - 1, 0, -1) if n == 1 or k[:n] in self.usable))
                      for k, v in sizes.items()}
        self._fits: dict = {}
        self.kept_bytes, self._kept = kept_bytes, 0
        self._steps: dict[int, int] = {}       # column and unit → the next column
        self._columns: list[bytes] = []        # of every edge under way its node and the node of the token before
        self._numbers: dict[bytes, int] = {}
        self._last: list[int] = []             # units in the last token of a column's prefix
        self._nodes: dict[int, int] = {}       # the pieces as a tree: node and unit → the next node
        self._piece: list = [None]             # the piece that ends at a node
        self._inner = bytearray(1)             # whether a longer piece goes on from it

    def _rank(self, a, b):
        return self.pairs.get((a, b)) if self.pairs is not None else self.ranks.get(a + b)

    def _splits(self) -> dict:
        if self.pairs is not None:
            out: dict = {}
            for (a, b), r in self.pairs.items():
                t = a + b
                if t in self.tokens and (t not in out or r < self.pairs[out[t]]):
                    out[t] = (a, b)
            return out
        return {t: s for t in self.tokens if len(t) > 1 and (s := self._last_merge(t))}

    def _last_merge(self, text):
        """The two parts of the final merge when ``text`` is encoded by merging, else None."""
        units = [text[i:i + 1] for i in range(len(text))]
        while len(units) > 2:
            best = min(((r, i) for i in range(len(units) - 1)
                        if (r := self._rank(units[i], units[i + 1])) is not None), default=None)
            if best is None:
                return None
            i = best[1]
            units[i:i + 2] = [units[i] + units[i + 1]]
        return tuple(units) if self._rank(*units) is not None else None

    def _meets(self, a, b, build: bool = False) -> bool:
        """Whether ``a`` and ``b`` stand side by side untouched (``build``: until they merge)."""
        rank, n = self._rank, len(a)
        for i, swallowed_a in self.right[a]:
            s = a[n - i:]
            for j, swallowed_b in self.left[b]:
                r = rank(s, b[:j])
                if r is not None and r < swallowed_a and r <= swallowed_b:
                    if not (build and i == n and j == len(b)):
                        return False
        return True

    def fits(self, a, b) -> bool:
        key = (a, b)
        ok = self._fits.get(key)
        if ok is None:
            if len(self._fits) >= 300_000:  # a cache only: bounds a worker's memory
                self._fits.clear()
            ok = self._fits[key] = self._meets(a, b)
        return ok

    def _begin(self) -> None:
        """The tree of the pieces, once, and no column but that of the empty prefix (number 0), which is
        the column after a unit outside the vocabulary as well."""
        if not self._nodes:
            for t in self.usable:
                at = 0
                for unit in numbered(t):
                    to = self._nodes.get(at << UNIT_BITS | unit)
                    if to is None:
                        to = self._nodes[at << UNIT_BITS | unit] = len(self._piece)
                        self._piece.append(None)
                        self._inner[at] = 1
                        self._inner.append(0)
                    at = to
                self._piece[at] = t
        for kept in (self._steps, self._columns, self._numbers, self._last):
            kept.clear()
        self._kept = 0
        self._column(array("q", [0]).tobytes(), 1)

    def _column(self, edges: bytes, last: int) -> int:
        number = self._numbers.get(edges)
        if number is None:
            number = self._numbers[edges] = len(self._columns)
            self._columns.append(edges)
            self._last.append(last)
            self._kept += COLUMN_BYTES + len(edges)
        return number

    def _step(self, column: int, unit: int) -> int:
        """The column after ``column`` and one more unit: of the edges that end there, the one that
        fits the token before it is the last token. A unit outside the vocabulary merges with nothing."""
        piece, inner, child, found, under_way = self._piece, self._inner, self._nodes.get, 0, array("q")
        for edge in array("q", self._columns[column]):  # longest first
            before = edge & 0xFFFFFFFF
            node = child(edge >> 32 << UNIT_BITS | unit)
            if node is None:
                continue
            if not found and piece[node] is not None and (not before or self.fits(piece[before], piece[node])):
                found = node  # a prefix has one encoding
            if inner[node]:
                under_way.append(node << 32 | before)
        under_way.append(found)  # the edge that begins here
        full = self._kept >= self.kept_bytes
        if full:
            self._begin()
        to = self._column(under_way.tobytes(), len(piece[found]) if found else 1)
        if not full:  # else ``column`` is forgotten
            self._steps[column << UNIT_BITS | unit] = to
            self._kept += STEP_BYTES
        return to

    def last_sizes(self, text) -> list[int]:
        """For every prefix of ``text`` from one unit on: how many units the last token of its encoding has."""
        if not self._columns:
            self._begin()
        known, last, at, out = self._steps.get, self._last, 0, []
        for unit in numbered(text):
            to = known(at << UNIT_BITS | unit)
            if to is None:
                to = self._step(at, unit)
            out.append(last[to])
            at = to
        return out

    def prefixes(self, text) -> tuple[list[int], list[int]]:
        """For every prefix of ``text``: its exact token count and where its last token starts.

        A unit outside the vocabulary is a token of its own that merges with nothing."""
        count, start = [0], [-1]
        for end, size in enumerate(self.last_sizes(text), 1):
            start.append(end - size)
            count.append(count[end - size] + 1)
        return count, start

    def encode(self, text) -> list:
        """The token units of ``text``: the one path whose neighbours all fit, searched with the
        longest edge first. Every prefix has one encoding, so a place left without a way on is
        never entered again."""
        n, sizes, spans, fits, short = len(text), self.sizes.get, self.spans, self.fits, SHORT
        out: list = []
        places, at, below, dead = [0], 0, n + 1, set()  # below: only edges shorter than this
        while at < n:
            last = out[-1] if out and out[-1] in spans else None
            for size in sizes(text[at:at + HEAD], short):
                e = at + size
                if size >= below or e > n or e in dead:
                    continue
                t = text[at:e]
                if t in spans:
                    if last is None or fits(last, t):
                        break
                elif size == 1:  # outside the vocabulary
                    break
            else:
                dead.add(at)
                places.pop()
                below = len(out.pop())
                at = places[-1]
                continue
            out.append(t)
            places.append(e)
            at, below = e, n + 1
        return out


def numbered(text) -> Iterable[int]:
    """The units of a text as numbers: bytes or code points."""
    return text if isinstance(text, bytes) else map(ord, text)


def merge_encode(bpe: Bpe, text: Sequence) -> list:
    """Encoding by replayed merges, the plain definition; the tests' reference."""
    units = [text[i:i + 1] for i in range(len(text))]
    while True:
        heap = [(r, i) for i in range(len(units) - 1)
                if (r := bpe._rank(units[i], units[i + 1])) is not None]
        if not heap:
            return units
        heapq.heapify(heap)
        i = heap[0][1]
        units[i:i + 2] = [units[i] + units[i + 1]]


@lru_cache(maxsize=2)
def byte_level(path: str) -> tuple[Bpe, tuple[tuple[str, int], ...]]:
    """Vocabulary of a byte-level BPE .json file, and its added tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    back = {c: b for b, c in byte_symbols().items()}
    raw = lambda s: bytes(back[c] for c in s)
    tokens = {raw(t): i for t, i in spec["model"]["vocab"].items() if all(c in back for c in t)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    pairs = {(raw(a), raw(b)): r for r, (a, b) in enumerate(merges)}
    return Bpe(tokens, pairs=pairs), tuple((t["content"], t["id"]) for t in spec["added_tokens"])


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others for U+0100 upwards in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
