"""Pre-tokenisation and piece coding shared by the two byte-level BPE operators.

Pieces, the matches of the vocabulary's pattern, are found for a whole chunk of
documents at once: where a text has only the characters of ``_allowed`` (ASCII
and Latin letters), piece starts follow from the classes of neighbouring bytes;
any other text is cut by the pattern itself. Each distinct piece of a chunk is
coded once, and codes are remembered under the piece's 64-bit hash, together with the
piece's bytes: every occurrence is compared with them, so two pieces with one hash
never share their ids.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from .base import prefix_hash, range_hash

#: fixed values: the pattern of the vocabulary files, white space as Unicode's property
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_find = regex.compile(PATTERN).findall

_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_class = np.full(256, _OTHER, np.uint8)
_class[[9, 10, 13, 32]] = _SPACE
_class[48:58] = _DIGIT
_class[65:91] = _class[97:123] = _LETTER
_class[128:] = _LETTER                  # inside allowed texts: U+00C0 to U+017F
_allowed = np.zeros(256, bool)
_allowed[[9, 10, 13]] = _allowed[32:127] = _allowed[0x80:0xC0] = _allowed[0xC3:0xC6] = True
#: contractions by their letters after the apostrophe
_TWO, _THREE = b"stmd", (b"re", b"ve", b"ll")


def piece_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Ascending starts of all pieces of a chunk's documents."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64)
    cls = _class[buf]
    start = np.zeros(n + 1, bool)
    start[1:n] = cls[1:] != cls[:-1]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start[edge] = True
    # the last white space before anything else stands alone; a blank joins what follows
    space = cls == _SPACE
    after = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n]) + 1
    start[after - 1] = True
    start[after[buf[after - 1] == 32]] = False
    # an apostrophe that begins a piece takes a contraction's letters with it
    mark = np.flatnonzero(buf == 39)
    if len(mark):
        before = np.where(edge[mark], _LETTER, cls[mark - 1])
        mark = mark[(before != _OTHER) & (edge[mark] | (buf[mark - 1] != 32))]
        room = off[np.searchsorted(off, mark, "right")] - mark      # bytes to the document's end
        padded = np.append(buf, np.zeros(3, np.uint8))
        one, two = padded[mark + 1], padded[mark + 2]
        short = mark[(room > 1) & np.isin(one, list(_TWO))]
        long = np.zeros(len(mark), bool)
        for a, b in _THREE:
            long |= (one == a) & (two == b)
        long = mark[(room > 2) & long]
        for place, size in ((short, 2), (long, 3)):
            start[place + 1] = False
            start[place + size] = True
    # texts with other characters: by the pattern
    odd = ~_allowed[buf]
    odd[:-1] |= (buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))
    if odd.any():
        for d in np.unique(np.searchsorted(off, np.flatnonzero(odd), "right") - 1).tolist():
            lo, hi = int(off[d]), int(off[d + 1])
            sizes = [len(p.encode()) for p in _find(buf[lo:hi].tobytes().decode())]
            start[lo:hi] = False
            start[lo + np.cumsum([0, *sizes[:-1]])] = True
    start[n] = False
    return np.flatnonzero(start)


class PieceCoder:
    """Codes chunks of documents; remembers the ids of every piece it has met.

    About 50 bytes a remembered piece: its hash in a sorted array, its ids in one pool
    and its bytes in another. At ``limit`` pieces or ``limit_bytes`` bytes of them all is
    forgotten; what is forgotten is coded anew, with the same result.
    """

    def __init__(self, encode: Callable[[bytes], list[int]], limit: int = 3_000_000,
                 limit_bytes: int = 64 << 20):
        self.encode, self.limit, self.limit_bytes = encode, limit, limit_bytes
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)          # sorted hashes and their entries
        self.entry = np.zeros(0, np.int64)
        self.fresh: dict[int, int] = {}             # hashes not yet merged -> entry
        self.pool = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.raw = np.zeros(1 << 17, np.uint8)      # the pieces' bytes, where each begins, its length
        self.raw_begin = np.zeros(1 << 14, np.int64)
        self.raw_size = np.zeros(1 << 14, np.int64)
        self.same_hash: dict[bytes, int] = {}       # pieces whose hash another piece holds -> entry
        self.n = self.used = self.raw_used = 0

    def _add(self, piece: bytes) -> int:
        ids = self.encode(piece)
        if self.n == len(self.begin):
            for name in ("begin", "size", "raw_begin", "raw_size"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.raw_used + len(piece) > len(self.raw):
            self.raw = np.concatenate([self.raw, np.zeros_like(self.raw)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.raw[self.raw_used:self.raw_used + len(piece)] = np.frombuffer(piece, np.uint8)
        self.begin[self.n], self.size[self.n] = self.used, len(ids)
        self.raw_begin[self.n], self.raw_size[self.n] = self.raw_used, len(piece)
        self.used += len(ids)
        self.raw_used += len(piece)
        self.n += 1
        return self.n - 1

    def _verified(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, entry: np.ndarray
                  ) -> np.ndarray:
        """``entry`` per piece, corrected where the remembered bytes are not the piece's."""
        size = end - start
        wrong = self.raw_size[entry] != size
        # pieces cover the chunk: byte i of it against the remembered byte
        there = np.repeat(self.raw_begin[entry] - start, size)
        there += np.arange(len(buf))
        np.minimum(there, len(self.raw) - 1, out=there)
        off = np.flatnonzero(self.raw[there] != buf)
        wrong[np.searchsorted(start, off, "right") - 1] = True
        for i in np.flatnonzero(wrong).tolist():
            piece = buf[start[i]:end[i]].tobytes()
            if piece not in self.same_hash:
                self.same_hash[piece] = self._add(piece)
            entry[i] = self.same_hash[piece]
        return entry

    def _merge(self) -> None:
        keys = np.fromiter(self.fresh, np.uint64, len(self.fresh))
        entry = np.fromiter(self.fresh.values(), np.int64, len(self.fresh))
        keys, entry = np.concatenate([self.keys, keys]), np.concatenate([self.entry, entry])
        order = np.argsort(keys)
        self.keys, self.entry, self.fresh = keys[order], entry[order], {}

    def chunk(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk's documents, and each document's offset among them."""
        if self.n > self.limit or self.raw_used > self.limit_bytes:
            self._reset()
        start = piece_starts(buf, off)
        end = np.append(start[1:], len(buf)) if len(start) else start
        hashes = range_hash(prefix_hash(buf), start, end)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        entry = np.full(len(keys), -1, np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
            entry[known] = self.entry[at[known]]
        raw, fresh = buf.tobytes(), self.fresh
        todo = np.flatnonzero(entry < 0)
        for i, key, a, b in zip(todo.tolist(), keys[todo].tolist(), start[first[todo]].tolist(),
                                end[first[todo]].tolist()):
            place = fresh.get(key)
            if place is None:
                place = fresh[key] = self._add(raw[a:b])
            entry[i] = place
        if len(fresh) > 1 << 16:
            self._merge()
        entry = self._verified(buf, start, end, entry[which.reshape(-1)])
        size = self.size[entry]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(self.begin[entry] - upto[:-1], size) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(start, off)]
