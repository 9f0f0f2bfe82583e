"""Byte-level BPE encoding and decoding by a lazily determinised transducer.

A sequence of tokens is the BPE encoding of its bytes exactly if every two
neighbours are: merging greedily by rank never joins across a boundary of
either. So the merges compile into a transducer over bytes whose states are
pairs (last token, place in the trie of all tokens): a byte moves down the
trie; where a token ends, and it may follow the last token, the transducer may
emit it and return to the root. After every prefix exactly one path stands at
the root, since a prefix has one encoding.

``Transducer`` determinises this on demand: a state is the set of all paths
that are still possible. Every path begins within the longest token's bytes, so
what all of them share lies behind a bounded lookahead and is emitted.
Transitions are kept per (state, byte) and forgotten together at ``limit``
states.

``Decoder`` turns ids back into text as they come, with a UTF-8 state machine
that holds an unfinished character over to the next token.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import chunks, local_path
from .pieces import PieceCoder

_U4 = np.dtype("<u4")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """The vocabulary as merges: every longer token is made of two by its last merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = dict(zip(ranks.values(), ranks))
        self.joined: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for token, rank in ranks.items():
            if len(token) > 1:
                pair = self._last_merge(token, rank)
                if pair:
                    self.parts[rank] = pair
                    self.joined[pair] = rank
        self._fits: dict[tuple[int, int], bool] = {}

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        word = [token[i:i + 1] for i in range(len(token))]
        while len(word) > 2:
            found = [(self.ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(word, word[1:]))]
            best, i = min(found)
            if best >= rank:
                return None     # never built by merges
            word[i:i + 2] = [word[i] + word[i + 1]]
        return self.ranks[word[0]], self.ranks[word[1]]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE keeps the boundary between two tokens.

        Undo the merges that built both, latest first. A merge across the
        boundary happens if at some moment the two tokens that touch it form a
        pair that ranks before the next merge on either side.
        """
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 400_000:
                self._fits.clear()
            known = self._fits[key] = self._keeps(left, right)
        return known

    def _keeps(self, left: int, right: int) -> bool:
        joined, parts = self.joined, self.parts
        # `until`: rank of the earliest merge undone so far; on equal ranks the left one came first
        until = 1 << 60
        while True:
            across = joined.get((left, right))
            if across is not None and across < until:
                return False
            a, b = parts.get(left), parts.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                until, left = left, a[1]
            else:
                until, right = right + 1, b[0]


class Transducer:
    """The transducer, determinised on demand.

    A state is the set of paths that are still possible after the bytes read:
    ``(last token, trie node)`` pairs, of which one stands at the root; its last
    token is the last token of the encoding of what was read (``ends``).
    """

    #: bytes between two attempts to emit; tokens leave at most this much later than they could
    STRIDE = 256

    def __init__(self, ranks: dict[bytes, int], limit: int = 250_000):
        self.merges, self.limit = Merges(ranks), limit
        self.size = {rank: len(token) for token, rank in ranks.items()}
        # trie: children by (node * 256 + byte); token that ends in a node; bytes down to it
        self.child: dict[int, int] = {}
        self.token, self.inner, self.depth = [-1], [True], [0]
        for token, rank in ranks.items():
            if len(token) > 1 and rank not in self.merges.parts:
                continue
            node = 0
            for b in token:
                nxt = self.child.get(node * 256 + b)
                if nxt is None:
                    nxt = self.child[node * 256 + b] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                    self.depth.append(self.depth[node] + 1)
                    self.inner[node] = True
                node = nxt
            self.token[node] = rank
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.paths: list[tuple] = []
        self.ends: list[int] = []
        self.moves: dict[int, int] = {}      # state * 256 + byte -> state
        self._state([-1 << 32], -1)

    def _state(self, paths: list[int], end: int) -> int:
        """Number of a state; a path is ``last token << 32 | node``, sorted for comparison."""
        key = tuple(sorted(paths))
        known = self.number.get(key)
        if known is None:
            known = self.number[key] = len(self.paths)
            self.paths.append(key)
            self.ends.append(end)
        return known

    def _move(self, state: int, byte: int) -> int:
        out, end, may_follow = [], -1, self.merges.may_follow
        for path in self.paths[state]:
            last, node = path >> 32, path & 0xFFFFFFFF
            nxt = self.child.get(node << 8 | byte)
            if nxt is None:
                continue
            if self.inner[nxt]:
                out.append(last << 32 | nxt)
            token = self.token[nxt]
            if token >= 0 and (last < 0 or may_follow(last, token)):
                out.append(token << 32)
                end = token
        to = self.moves[state << 8 | byte] = self._state(out, end)
        return to

    def _chain(self, trail: list[int], at: int) -> list[int]:
        """Encoding of the first ``at`` bytes that ``trail`` covers."""
        out = []
        while at > 0:
            out.append(trail[at - 1])
            at -= self.size[trail[at - 1]]
        out.reverse()
        return out

    def _settled(self, trail: list[int], state: int) -> list[int]:
        """Tokens that all possible paths share: no continuation can change them."""
        chains = [self._chain(trail, len(trail) - self.depth[p & 0xFFFFFFFF]) for p in self.paths[state]]
        n, first = 0, min(chains, key=len)
        while n < len(first) and all(c[n] == first[n] for c in chains):
            n += 1
        return first[:n]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        if len(self.paths) > self.limit:
            self._reset()
        state, moves, ends, trail, out = 0, self.moves, self.ends, [], []
        for byte in piece:
            nxt = moves.get(state << 8 | byte)
            state = self._move(state, byte) if nxt is None else nxt
            trail.append(ends[state])
            if len(trail) >= self.STRIDE:
                sure = self._settled(trail, state)
                out += sure
                del trail[:sum(self.size[t] for t in sure)]
        return out + self._chain(trail, len(trail))


def _utf8_machine() -> list[list[int]]:
    """``table[state][byte]`` -> state; 0: between characters, 8: not UTF-8.

    States 1-3 await that many plain continuation bytes; 4-7 follow the lead bytes
    whose next byte is restricted (E0, ED, F0, F4).
    """
    table = [[8] * 256 for _ in range(9)]
    def fill(state, low, high, to):  # noqa: E306
        for b in range(low, high + 1):
            table[state][b] = to
    fill(0, 0x00, 0x7F, 0)
    fill(0, 0xC2, 0xDF, 1)
    fill(0, 0xE1, 0xEF, 2)
    fill(0, 0xF1, 0xF3, 3)
    for lead, state in ((0xE0, 4), (0xED, 5), (0xF0, 6), (0xF4, 7)):
        table[0][lead] = state
    fill(1, 0x80, 0xBF, 0)
    fill(2, 0x80, 0xBF, 1)
    fill(3, 0x80, 0xBF, 2)
    fill(4, 0xA0, 0xBF, 1)
    fill(5, 0x80, 0x9F, 1)
    fill(6, 0x90, 0xBF, 2)
    fill(7, 0x80, 0x8F, 2)
    return table


UTF8 = _utf8_machine()


class Decoder:
    """Streaming decoder: feed ids, take text; unfinished characters wait.

    Bytes that cannot be UTF-8 become U+FFFD in the text (one per broken
    sequence start); ``feed`` also returns the exact bytes.
    """

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.whole: dict[int, str | None] = {}
        self.reset()

    def reset(self) -> None:
        self.state, self.waiting = 0, bytearray()

    def _text_of(self, token: int) -> str | None:
        """The text of a token that begins and ends between characters."""
        if token not in self.whole:
            state = 0
            for b in self.bytes_of[token]:
                state = UTF8[state][b] if state < 8 else 8
            self.whole[token] = self.bytes_of[token].decode() if state == 0 else None
        return self.whole[token]

    def feed(self, ids: list[int]) -> str:
        out = []
        for token in ids:
            text = self._text_of(token) if self.state == 0 else None
            if text is not None:
                out.append(text)
                continue
            for b in self.bytes_of[token]:
                state = UTF8[self.state][b]
                if state == 8:
                    if self.waiting:
                        out.append("�")
                        self.waiting.clear()
                    state = UTF8[0][b]
                    if state == 8:
                        out.append("�")
                        self.state = 0
                        continue
                self.state = state
                self.waiting.append(b)
                if state == 0:
                    out.append(self.waiting.decode())
                    self.waiting.clear()
        return "".join(out)

    def finish(self) -> str:
        rest = "�" if self.waiting else ""
        self.reset()
        return rest

    def text(self, ids: np.ndarray, step: int = 4096) -> str:
        """The text of a whole id sequence, decoded as a stream."""
        parts = [self.feed(ids[i:i + step].tolist()) for i in range(0, len(ids), step)]
        return "".join(parts) + self.finish()


_coders: dict[str, PieceCoder] = {}
_decoders: dict[str, Decoder] = {}


def coder(vocabulary: str) -> PieceCoder:
    """One transducer per worker process and vocabulary."""
    if vocabulary not in _coders:
        _coders[vocabulary] = PieceCoder(Transducer(load_ranks(local_path(vocabulary))).encode)
    return _coders[vocabulary]


def decoder(vocabulary: str) -> Decoder:
    if vocabulary not in _decoders:
        ranks = load_ranks(local_path(vocabulary))
        _decoders[vocabulary] = Decoder(dict(zip(ranks.values(), ranks)))
    return _decoders[vocabulary]


def encode(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (ids as little-endian uint32 bytes), one row per document.

    A null or empty text has no ids.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        code = coder(vocabulary)
        for batch in batches:
            for lo, hi, buf, off in chunks(batch.column(1)):
                ids, at = code.chunk(buf, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at)),
                     pa.array([ids[a:b].astype(_U4).tobytes() for a, b in zip(at[:-1], at[1:])],
                              pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")


def decode(coded: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """``doc_id, n_tokens, ids, text`` from rows of :func:`encode`."""
    kind = coded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        machine = decoder(vocabulary)
        for batch in batches:
            texts = [machine.text(np.frombuffer(raw, _U4)) for raw in batch.column(2).to_pylist()]
            yield batch.append_column("text", pa.array(texts, pa.string()))

    return coded.select("doc_id", "n_tokens", "ids") \
        .mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, text string")


def round_trip(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", doc_id: str = "doc_id",
               text: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``), one row per document.

    Encodes and decodes in one pass, so a task holds one Python worker and
    neither ids nor texts travel between two.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    extra = ", ids binary" if with_ids else ""

    def run(batches):
        code, machine = coder(vocabulary), decoder(vocabulary)
        for batch in batches:
            for lo, hi, buf, off in chunks(batch.column(1)):
                all_ids, at = code.chunk(buf, off)
                parts = [all_ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                ids = [x.astype(_U4).tobytes() for x in parts]
                back = [machine.text(x).encode() for x in parts]
                columns = {
                    "doc_id": batch.column(0).slice(lo, hi - lo), "n_tokens": pa.array(np.diff(at)),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string())}
                if with_ids:
                    columns["ids"] = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}")
