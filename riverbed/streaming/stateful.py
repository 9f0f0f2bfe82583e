"""Keyed stateful stream processors (``transformWithStateInPandas``).

State is bounded: a few numbers and at most ``size`` pending values per key (count
windows), the open periods (click cap), ``n`` entries per window (top-n). A call serves a
bucket of keys or windows: state reads and writes cost a round trip each, whatever they
carry. Rows of one key inside one micro-batch arrive in no particular order. The click cap
and the top-n fold them chunk by chunk; the count windows get them as sorted blocks
(``operators.value_blocks``), one after the other.

Time values come in as epoch microseconds (computed by Spark upstream),
so no time-zone logic runs in Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


#: values folded at a time, and rows of a frame given out, about
RUN = 1 << 16


def _in_order(rows: Iterable[Mapping]) -> Iterator[np.ndarray]:
    """The values of one key's blocks of this micro-batch, block by block."""
    blocks = [(b, v) for chunk in rows for b, v in zip(chunk["block"].tolist(), chunk["vals"])]
    for _, vals in sorted(blocks, key=lambda x: x[0]):
        yield np.asarray(vals, dtype="int64")


def _read_table(state) -> pd.DataFrame | None:
    """The table a value state of one binary column holds."""
    stored = state.get()
    return pa.ipc.open_stream(bytes(stored[0])).read_pandas() if stored is not None else None


def _write_table(state, table: pd.DataFrame) -> None:
    if not len(table):
        state.clear()
        return
    arrow = pa.Table.from_pandas(table, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, arrow.schema) as out:
        out.write_table(arrow)
    state.update((sink.getvalue().to_pybytes(),))


def _runs(blocks: Iterable[np.ndarray]) -> Iterator[np.ndarray]:
    """Small blocks that follow each other in one array."""
    held, n = [], 0
    for vals in blocks:
        held.append(vals)
        n += len(vals)
        if n >= RUN:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


class Bucket:
    """The keys of one bucket: those in the state and those of this micro-batch's blocks.

    A key's place among ``keys`` is its place in every column of numbers. Places never
    change; new keys come last."""

    def __init__(self, key_names: Sequence[str], stored: pd.DataFrame | None, rows: Iterator[pd.DataFrame]):
        names = list(key_names)
        blocks = pd.concat(list(rows), ignore_index=True)
        known = blocks[names].iloc[:0] if stored is None else stored[names]
        every = pd.concat([known, blocks[names]], ignore_index=True) if len(known) else blocks[names]
        place = every.groupby(names, sort=False, dropna=False).ngroup().to_numpy()
        self.keys = every[~pd.Series(place).duplicated().to_numpy()].reset_index(drop=True)
        self._place = place[len(known):]
        self._order = np.argsort(self._place, kind="stable")
        self._block, self._vals = blocks["block"].to_numpy(), blocks["vals"].to_numpy()

    def column(self, stored: np.ndarray | None) -> np.ndarray:
        """A stored column with a zero for every new key."""
        out = np.zeros(len(self.keys), dtype="int64")
        if stored is not None:
            out[:len(stored)] = stored
        return out

    def matrix(self, stored: Iterable[bytes], width: int) -> np.ndarray:
        """Stored columns side by side, a row per key."""
        out = np.zeros((len(self.keys), width), dtype="int64")
        for i, col in enumerate(stored):
            col = np.frombuffer(col, dtype="int64")
            out[:len(col), i] = col
        return out

    def __iter__(self) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
        """Each key of the micro-batch: its place and its values in order."""
        place = self._place[self._order]
        edges = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            at = self._order[lo:hi]
            yield int(place[lo]), _runs(_in_order([{"block": self._block[at], "vals": self._vals[at]}]))

    def frames(self, parts: Iterable[tuple[int, dict[str, np.ndarray]]]) -> Iterator[pd.DataFrame]:
        """Rows given out, ``(place, columns)`` a key, in frames of about ``RUN`` rows."""
        held, n = [], 0

        def frame():
            sizes = [len(next(iter(cols.values()))) for _, cols in held]
            keys = self.keys.take(np.repeat([place for place, _ in held], sizes)).reset_index(drop=True)
            return keys.assign(**{c: np.concatenate([cols[c] for _, cols in held]) for c in held[0][1]})
        for place, cols in parts:
            held.append((place, cols))
            n += len(next(iter(cols.values())))
            if n >= RUN:
                yield frame()
                held, n = [], 0
        if held:
            yield frame()


def _complete_windows(held_n: int, held_sum: int, vals: np.ndarray, size: int):
    """Windows of ``size`` completed by ``vals`` after ``held_n`` pending values
    summing to ``held_sum``: (totals of complete windows, new pending count,
    index in ``vals`` where the new pending values start)."""
    pos = held_n + np.arange(len(vals))
    n_done = (held_n + len(vals)) // size
    groups = pos // size
    totals = np.zeros(n_done, dtype="int64")
    inside = groups < n_done
    np.add.at(totals, groups[inside], vals[inside].astype("int64"))     # exact: no floats
    if n_done:
        totals[0] += held_sum
    rest_from = n_done * size - held_n if n_done else 0
    return totals, (held_n + len(vals)) % size, rest_from


class CountWindowAverage(StatefulProcessor):
    """Every ``size`` rows of a key -> one ``(key, window_no, n, total, avg)``.

    Runs per *bucket* of keys. ``state`` picks how the unfinished windows are held, as in the
    three original variants: ``list`` (pending values in list state), ``value``
    (running sums in one value state) or ``map`` (pending values in map state keyed by
    arrival sequence). An element holds this value of all keys of the bucket, as a column. A
    value state counts the windows emitted and the rows pending of each key. Input: sorted
    blocks of the keys' values (keys, ``block, vals``). Output mode: append.
    """

    def __init__(self, key_names: Sequence[str], size: int = 3, state: str = "list"):
        if state not in ("list", "value", "map"):
            raise ValueError(state)
        self.key_names, self.size, self.kind = list(key_names), size, state

    @staticmethod
    def output_schema(key_ddl: str) -> str:
        return f"{key_ddl}, window_no long, n long, total long, avg double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        if self.kind == "list":
            self.pending = handle.getListState("pending", "col binary")
        elif self.kind == "map":
            self.pending = handle.getMapState("pending", "seq long", "col binary")
        else:
            self.pending = handle.getValueState("pending", "col binary")
        self.windows = handle.getValueState("windows", "table binary")

    def _held(self) -> list[bytes]:
        """Columns of pending values in arrival order, or the column of their sums."""
        if self.kind == "list":
            return [bytes(c[0]) for c in self.pending.get()]
        if self.kind == "map":
            return [c for _, c in sorted((k[0], bytes(c[0])) for k, c in self.pending.iterator())]
        stored = self.pending.get()
        return [bytes(stored[0])] if stored is not None else []

    def _hold(self, cols: list[bytes]) -> None:
        if not cols:
            self.pending.clear()
        elif self.kind == "list":
            self.pending.put([(c,) for c in cols])
        elif self.kind == "value":
            self.pending.update((cols[0],))
        else:
            self.pending.clear()
            for i, c in enumerate(cols):
                self.pending.updateValue((i,), (c,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stored = _read_table(self.windows)
        bucket = Bucket(self.key_names, stored, rows)
        done, pending = (bucket.column(None if stored is None else stored[c].to_numpy())
                         for c in ("windows", "pending"))
        width = 1 if self.kind == "value" else self.size - 1
        held = bucket.matrix(self._held(), width)

        def parts():
            for at, runs in bucket:
                n = int(pending[at])
                for vals in runs:
                    # what the state holds of the unfinished window: its sum, or its values
                    mine = held[at] if self.kind == "value" else held[at, :n]
                    totals, left, start = _complete_windows(n, int(mine.sum()), vals, self.size)
                    k, rest = len(totals), vals[start:]
                    if self.kind == "value":
                        held[at] = rest.sum() + (0 if k else mine)
                    else:
                        held[at, left - len(rest):left] = rest
                    n = left
                    if k:
                        yield at, {"window_no": np.arange(done[at] + 1, done[at] + k + 1, dtype="int64"),
                                   "n": np.full(k, self.size, dtype="int64"), "total": totals,
                                   "avg": totals.astype("float64") / self.size}
                        done[at] += k
                pending[at] = n
        yield from bucket.frames(parts())
        # a window of one row leaves nothing pending
        used = width if self.kind == "value" else int(pending.max())
        self._hold([held[:, i].tobytes() for i in range(used)])
        _write_table(self.windows, bucket.keys.assign(windows=done, pending=pending))

    def close(self) -> None:
        pass


class CountTriggerEvictor(StatefulProcessor):
    """Fire every ``every`` rows of a key over the last ``size`` rows.

    A count trigger that fires without purging plus an evictor that keeps
    the newest ``size`` rows: at positions every, 2*every, ... emit
    ``(key, rn, n, total)``. Runs per *bucket* of keys. State: rows seen of each key, and the
    newest ``size`` values, oldest first; an element holds one value of all keys of the
    bucket, as a column. Input: sorted blocks of the keys' values (keys, ``block, vals``).
    """

    def __init__(self, key_names: Sequence[str], every: int = 2, size: int = 3):
        self.key_names, self.every, self.size = list(key_names), every, size

    @staticmethod
    def output_schema(key_ddl: str) -> str:
        return f"{key_ddl}, rn long, n long, total long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "table binary")
        self.tail = handle.getListState("tail", "col binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stored = _read_table(self.seen)
        bucket = Bucket(self.key_names, stored, rows)
        counts = bucket.column(None if stored is None else stored["seen"].to_numpy())
        tails = bucket.matrix([] if stored is None else [bytes(c[0]) for c in self.tail.get()], self.size)

        def parts():
            for at, runs in bucket:
                seen = int(counts[at])
                tail = tails[at, :min(seen, self.size)].copy()
                for fresh in runs:
                    vals = np.concatenate([tail, fresh])
                    cum = np.concatenate([[0], np.cumsum(vals)])
                    rn = np.arange(seen + 1, seen + len(fresh) + 1, dtype="int64")
                    ends = np.arange(len(tail) + 1, len(vals) + 1)      # end offsets of new rows
                    fire = rn % self.every == 0
                    rn, ends = rn[fire], ends[fire]
                    starts = np.maximum(ends - self.size, 0)
                    seen, tail = seen + len(fresh), vals[-self.size:]
                    if len(rn):
                        yield at, {"rn": rn, "n": np.minimum(rn, self.size), "total": cum[ends] - cum[starts]}
                counts[at] = seen
                tails[at, :len(tail)] = tail
        yield from bucket.frames(parts())
        self.tail.put([(tails[:, i].tobytes(),) for i in range(self.size)])
        _write_table(self.seen, bucket.keys.assign(seen=counts))

    def close(self) -> None:
        pass


class ClickCap(StatefulProcessor):
    """Per key: pass the first ``cap`` rows of each period, drop the rest,
    emit one ``alert`` row (the first dropped one) per period.

    Runs per *bucket* of keys (a hash of the key), so that one call, one state read and
    one write serve all of a bucket's keys, whose rows are counted together as columns.
    Input columns: ``seq`` (tie-break), ``ts_us`` and ``period_us`` (period start, epoch
    micros), the keys and ``carry`` columns passed through. State: one value, the table of
    (key, open period, rows passed, alert sent), so a row that comes late, but within the
    watermark, is counted in its own period and leaves newer ones alone; a micro-batch
    rewrites the tables of the buckets it touches. A timer at each period's end clears
    that period, so idle keys cost nothing.

    With ``processing_time=True`` (time mode ``ProcessingTime``) the period is the
    wall-clock day of the micro-batch, as in the original; not replayable. The clock
    shows ``clock_ms`` more than the engine's, so a test can put midnight where it likes.

    A bucket's micro-batch is folded chunk by chunk to the ``cap + 1`` earliest
    rows of each key and period: more can neither pass nor raise an alert.
    """

    def __init__(self, key_names: Sequence[str], carry: Sequence[str], cap: int = 100,
                 period_us: int = 86_400_000_000, seq: str = "seq",
                 processing_time: bool = False, clock_ms: int = 0):
        self.key_names, self.carry = list(key_names), list(carry)
        self.cap, self.period_us, self.seq = cap, period_us, seq
        self.processing_time, self.clock_ms = processing_time, clock_ms if processing_time else 0
        self.group = [*self.key_names, "period_us"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getValueState("entries", "table binary")

    def _earliest(self, frames: list[pd.DataFrame]) -> pd.DataFrame:
        df = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        order = np.lexsort((df[self.seq].to_numpy(), df["ts_us"].to_numpy()))
        df = df.iloc[order]
        return df[df.groupby(self.group, dropna=False, sort=False).cumcount() <= self.cap]

    def _timer(self, period: int) -> int:
        """Engine time at which ``period`` is over."""
        return (period + self.period_us) // 1000 - self.clock_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.processing_time:
            # the original resets at the next midnight of the wall clock
            now_us = (timerValues.getCurrentProcessingTimeInMs() + self.clock_ms) * 1000
            rows = (c.assign(period_us=now_us - now_us % self.period_us) for c in rows)
        kept = None
        for chunk in rows:
            kept = self._earliest([chunk] if kept is None else [kept, chunk])
        state = _read_table(self.entries)
        if state is None:
            kept = kept.assign(passed=0, alerted=False)
        else:
            kept = kept.merge(state, on=self.group, how="left")
            kept["passed"] = kept["passed"].fillna(0).astype("int64")
            kept["alerted"] = kept["alerted"].astype("boolean").fillna(False).astype(bool)
        groups = kept.groupby(self.group, dropna=False, sort=False)
        place = kept["passed"] + groups.cumcount()
        tag = np.where(place < self.cap, "pass",
                       np.where((place == self.cap) & ~kept["alerted"], "alert", ""))

        # every group's entry after this micro-batch replaces the one before it
        now = groups.agg(passed=("passed", "first"), alerted=("alerted", "first"), n=("passed", "size")) \
            .reset_index()
        total = now["passed"] + now.pop("n")
        now["alerted"], now["passed"] = now["alerted"] | (total > self.cap), np.minimum(total, self.cap)
        if state is not None:
            now = pd.concat([now, state], ignore_index=True).drop_duplicates(self.group, keep="first")
        _write_table(self.entries, now)
        first = int(now["period_us"].min())
        if state is None or first < state["period_us"].min():
            self.handle.registerTimer(self._timer(first))
        out = kept[tag != ""]
        if len(out):
            columns = [*self.key_names, *self.carry, "ts_us", "period_us"]
            yield out[columns].assign(tag=tag[tag != ""])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = _read_table(self.entries)
        if state is not None:
            now = (timerValues.getCurrentProcessingTimeInMs() if self.processing_time
                   else timerValues.getCurrentWatermarkInMs())
            now = max(now, expiredTimerInfo.getExpiryTimeInMs())
            left = state[(state["period_us"] + self.period_us) // 1000 - self.clock_ms > now]
            if len(left) < len(state):
                _write_table(self.entries, left)
            if len(left):
                self.handle.registerTimer(self._timer(int(left["period_us"].min())))
        return iter([])

    def close(self) -> None:
        pass


class TopNPerWindow(StatefulProcessor):
    """Top-n entries per window end, released by an event-time timer at window end + 1 ms.

    Runs per (run of neighbouring window ends, salt of the url), so that one call serves many
    windows. State: one table with at most ``n`` entries ``(window_end_ms, url, n)`` per
    open window, the best so far by ``(n desc, url asc)``; each finished window count
    arrives once from the upstream aggregation and is folded in chunk by chunk. One timer
    stands at the earliest open window's end; when it fires, every window that the
    watermark has passed goes out and the timer moves on.
    """

    def __init__(self, n: int = 3):
        self.n = n

    @staticmethod
    def output_schema() -> str:
        return "url string, window_end_ms long, n long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "table binary")

    def _ranked(self, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["window_end_ms", "n", "url"], ascending=[True, False, True])
        return table[table.groupby("window_end_ms").cumcount() < self.n]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = _read_table(self.best)
        top = held
        for chunk in rows:
            chunk = chunk[["window_end_ms", "url", "n"]]
            top = self._ranked(chunk if top is None else pd.concat([top, chunk], ignore_index=True))
        _write_table(self.best, top)
        first = int(top["window_end_ms"].min())
        if held is None or first < held["window_end_ms"].min():
            self.handle.registerTimer(first + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = _read_table(self.best)
        if held is not None:
            now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            due = held["window_end_ms"] + 1 <= now
            left = held[~due]
            _write_table(self.best, left)
            if len(left):
                self.handle.registerTimer(int(left["window_end_ms"].min()) + 1)
            if due.any():
                yield held[due][["url", "window_end_ms", "n"]]

    def close(self) -> None:
        pass
