"""Stateful processors (event time) for the streaming forms of the new-visitor
repair, the daily unique visitor and the bounce pattern.

The bounce processors (``transformWithState``) take their rows one by one;
those of the repair and of a whole device (``transformWithStateInPandas``) take
frames. Rows are kept in state as
``(ts, seq, value)``: the raw JSON text plus its event time in ms and
arrival position. The text is parsed again downstream, so state stays small
and typed. A call of the state store or a timer costs far more than a row, so
a group holds many devices: a part is a hash of the arrival position, or of the device and
its time bucket, so a device of any share of the rows spreads over tasks. Such steps are chained.

Timing follows the original's event-time rules:

* a 5 s tumbling window closes when the watermark reaches its end (the timer
  is registered at the window end); a row whose window has already closed is
  late and dropped;
* the pattern looks at rows in ``(ts, seq)`` order once the watermark has passed
  them, and times an entry out when the watermark has reached entry + limit.

Every timer at or below the batch watermark fires in the same micro-batch,
so the first callback of a key handles all of them (in time order) and
``done_until`` lets the others return at once. Only the earliest open
window / row has a timer; firing re-arms the next one.

Given no late rows, each processor emits exactly the rows of its batch form.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime, timezone
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shoplake.settings import WINDOW_MS

BUFFER_DDL = "w_end bigint, ts bigint, seq bigint, value string"
BUFFER_COLS = ["w_end", "ts", "seq", "value"]

WINDOW_PARTS = "mid string, part bigint, ts bigint, seq bigint, value string, at timestamp"
NO_SEQ = -(2**63)  # a missing position: before every other, as nulls are in Spark's order
REPAIR_OUTPUT = "value string, seq bigint, is_first boolean"
UV_DAYS = "mid string, visit_date string, ts bigint, seq bigint, value string"
FIRST_OF_DAY_ROWS = 20_000  # sorted at once, at least
UV_OUTPUT = "value string, seq bigint, ts bigint, visit_date string"
BOUNCE_BUFFER_DDL = "mid string, ts bigint, seq bigint, is_entry boolean, value string"
BOUNCE_PARTS = "mid string, kind string, ts bigint, seq bigint, is_entry boolean, value string, at timestamp"
BOUNCE_OUTPUT = "kind string, value string, seq bigint, ts bigint"
CLOSED_ROW = Row("mid", "part", "ts", "seq", "value", "at")
BOUNCE_PART = Row("mid", "kind", "ts", "seq", "is_entry", "value", "at")
BOUNCE_ROW = Row("kind", "value", "seq", "ts")


def day_text(ms: pd.Series, time_zone: str = "UTC") -> pd.Series:
    """Epoch ms -> ``yyyy-MM-dd`` in a zone (the jobs give the session's)."""
    return pd.to_datetime(ms.astype("int64"), unit="ms", utc=True).dt.tz_convert(time_zone).dt.strftime("%Y-%m-%d")


def _concat(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [f for f in frames if len(f)]
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()


def _records(df: pd.DataFrame, cols: list[str]) -> list[tuple]:
    return list(df[cols].itertuples(index=False, name=None))


def _state_frame(state, cols: list[str]) -> pd.DataFrame:
    rows = list(state.get()) if state.exists() else []
    return pd.DataFrame(rows, columns=cols)


class _WindowBuffer(StatefulProcessor):
    """Buffers rows per tumbling window; subclasses turn closed windows
    (sorted by window end, ts, seq) into output rows."""

    def __init__(self, window_ms: int = WINDOW_MS) -> None:
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", BUFFER_DDL)
        self.done = handle.getValueState("done_until", "wm bigint")
        self.init_state(handle)

    def init_state(self, handle: StatefulProcessorHandle) -> None:  # pragma: no cover
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _concat(rows)
        if len(df):
            w_end = (df["ts"] // self.window_ms + 1) * self.window_ms
            fresh = df.assign(w_end=w_end)[w_end > timerValues.getCurrentWatermarkInMs()]
            if len(fresh):  # rows of an already fired window are late and dropped
                self.buf.appendList(_records(fresh, BUFFER_COLS))
                self.handle.registerTimer(int(fresh["w_end"].min()))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expiry = expiredTimerInfo.getExpiryTimeInMs()
        if self.done.exists() and expiry <= self.done.get()[0]:
            return iter([])
        upto = max(expiry, timerValues.getCurrentWatermarkInMs())
        self.done.update((upto,))
        buf = _state_frame(self.buf, BUFFER_COLS)
        due = buf[buf["w_end"] <= upto]
        if not len(due):
            return iter([])
        rest = buf[buf["w_end"] > upto]
        self.buf.clear()
        if len(rest):
            self.buf.put(_records(rest, BUFFER_COLS))
            self.handle.registerTimer(int(rest["w_end"].min()))
        due = due.sort_values(["w_end", "ts", "seq"], kind="stable").reset_index(drop=True)
        out = self.on_windows(due)
        return iter([out]) if len(out) else iter([])

    def on_windows(self, due: pd.DataFrame) -> pd.DataFrame:  # pragma: no cover
        raise NotImplementedError


class _OpenRows(StatefulProcessor):
    """Keeps rows until the watermark reaches their last field. Only the earliest such time has a timer."""

    FIELDS: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", f"{self.FIELDS}, until bigint")
        self.armed = handle.getValueState("armed", "until bigint")

    def hold(self, rows: list[tuple]) -> None:
        if not rows:
            return
        self.buf.appendList(rows)
        first, armed = min(r[-1] for r in rows), self.armed.get()
        if armed is None or first < armed[0]:
            if armed is not None:
                self.handle.deleteTimer(armed[0])
            self._arm(first)

    def _arm(self, until: int) -> None:
        self.handle.registerTimer(until)
        self.armed.update((until,))

    def take(self, watermark: int) -> list[tuple]:
        """The rows whose time has come; the others stay."""
        due, rest = [], []
        for r in self.buf.get():
            (due if r[-1] <= watermark else rest).append(tuple(r))
        if rest:
            self.buf.put(rest)
            self._arm(min(r[-1] for r in rest))
        else:
            self.buf.clear()
            self.armed.clear()
        return due


class ClosedWindow(_OpenRows):
    """Rows of the windows of one span of time and part of it, given out when their window closes.

    The least row of each device goes on for the device's own group (``part`` 0), the others
    for a group of their own. Rows whose window has closed are late; they go on with
    ``part`` -1.
    """

    FIELDS = "mid string, ts bigint, seq bigint, value string"

    def __init__(self, split: int) -> None:
        self.split = split

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm, held = timerValues.getCurrentWatermarkInMs(), []
        for r in rows:
            if r.w_end <= wm:
                yield CLOSED_ROW(r.mid, -1, r.ts, r.seq, r.value, _time(wm + 1))
            else:
                held.append((r.mid, r.ts, r.seq, r.value, r.w_end))
        self.hold(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = sorted(self.take(timerValues.getCurrentWatermarkInMs()), key=device_order)
        others, last = int(key[0]) * self.split + int(key[1]) + 1, None
        for mid, ts, seq, value, w_end in due:
            yield CLOSED_ROW(mid, others if mid == last else 0, ts, seq, value, _time(w_end))
            last = mid


def _time(ms: int) -> datetime:
    return datetime.fromtimestamp(ms / 1000, timezone.utc)


def row_order(r: tuple) -> tuple:
    """``(ts, seq, ...)`` in the order of Spark, nulls first."""
    return r[0], r[1] is not None, r[1] or 0


def device_order(r: tuple) -> tuple:
    """``(mid, ts, seq, ...)`` by device, then as ``row_order``."""
    return r[0], *row_order(r[1:3])


class ClosedWindowFrames(StatefulProcessor):
    """``ClosedWindow`` by frames: the rows of a group that come together are one element of its state, as Arrow bytes.

    ``seq`` is never null here (``NO_SEQ``), so it stays an exact integer.
    """

    FIELDS = ["mid", "ts", "seq", "value", "w_end"]

    def __init__(self, split: int) -> None:
        self.split = split

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", "frame binary, until bigint")
        self.armed = handle.getValueState("armed", "until bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm, held = timerValues.getCurrentWatermarkInMs(), []
        for df in rows:
            late = df["w_end"] <= wm
            if late.any():
                yield _closed(df[late], -1, _times(pd.Series(wm + 1, df.index[late])))
                df = df[~late]
            if len(df):
                held.append(_packed(pa.Table.from_pandas(df[self.FIELDS], preserve_index=False)))
        if not held:
            return
        self.buf.appendList(held)
        first, armed = min(h[1] for h in held), self.armed.get()
        if armed is None or first < armed[0]:
            if armed is not None:
                self.handle.deleteTimer(armed[0])
            self._arm(first)

    def _arm(self, until: int) -> None:
        self.handle.registerTimer(until)
        self.armed.update((until,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm, due, rest = timerValues.getCurrentWatermarkInMs(), [], []
        for frame, until in self.buf.get():
            if until > wm:
                rest.append((bytes(frame), until))
                continue
            rows = pa.ipc.open_stream(bytes(frame)).read_all()
            open_rows = rows.filter(pc.greater(rows["w_end"], wm))
            if len(open_rows):
                rest.append(_packed(open_rows))
            due.append(rows.filter(pc.less_equal(rows["w_end"], wm)))
        if rest:
            self.buf.put(rest)
            self._arm(min(r[1] for r in rest))
        else:
            self.buf.clear()
            self.armed.clear()
        if due:
            df = pa.concat_tables(due).sort_by([(c, "ascending") for c in ("mid", "ts", "seq")]).to_pandas()
            others = int(key[0]) * self.split + int(key[1]) + 1
            yield _closed(df, np.where(df["mid"] == df["mid"].shift(), others, 0), _times(df["w_end"]))


def _packed(rows: pa.Table) -> tuple[bytes, int]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_table(rows)
    return sink.getvalue().to_pybytes(), pc.min(rows["w_end"]).as_py()


def _closed(df: pd.DataFrame, part, at: pd.Series) -> pd.DataFrame:
    return df[["mid", "ts", "seq", "value"]].assign(part=part, at=at)[["mid", "part", "ts", "seq", "value", "at"]]


def _times(ms: pd.Series) -> pd.Series:
    return pd.to_datetime(ms, unit="ms", utc=True)


class FirstOfDevice(StatefulProcessor):
    """New-visitor flag over closed windows, by frames.

    Group ``part`` 0 has the least row of each part of the closed windows, for many
    devices: all of a device's in one group. The least of the first ones ever is the device's
    new-visitor row. Of a device not seen before, one row is held at a time.
    Other rows come in groups of their own and only pass; the flag of late rows is null.
    ``seq`` is never null here (``NO_SEQ``).
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "mid string", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        part = int(key[1])
        if part:
            for df in rows:
                yield _flagged(df, None if part < 0 else False)
            return
        known, first = {}, None  # the state is asked once for a device and micro-batch
        for df in rows:
            for mid in df["mid"].unique():
                if mid not in known:
                    known[mid] = self.seen.containsKey((mid,))
            old = df["mid"].map(known).astype(bool)
            rest, new = [df[old]], df[~old]
            if len(new):
                new = (new if first is None else pd.concat([first, new])).sort_values(["ts", "seq"], kind="stable")
                again = new.duplicated("mid")
                rest.append(new[again])
                first = new[~again]
            for f in rest:
                if len(f):
                    yield _flagged(f, False)
        if first is not None:
            for mid in first["mid"]:
                self.seen.updateValue((mid,), (True,))
            yield _flagged(first, True)


def _flagged(df: pd.DataFrame, flag: bool | None) -> pd.DataFrame:
    return df[["value", "seq"]].assign(is_first=pd.Series([flag] * len(df), df.index, dtype="object"))


def _first_per_day(firsts: pd.DataFrame, last_day: str | None, time_zone: str = "UTC") -> tuple[pd.DataFrame, str | None]:
    """Rows in time order, one per closed window: keep those whose day differs
    from the previous row's day (the first compared with ``last_day``)."""
    days = day_text(firsts["ts"], time_zone).to_numpy(dtype=object)
    prev = np.concatenate([np.array([last_day], dtype=object), days[:-1]])
    keep = days != prev
    out = pd.DataFrame({
        "value": firsts["value"].to_numpy()[keep],
        "seq": firsts["seq"].to_numpy()[keep],
        "ts": firsts["ts"].to_numpy()[keep],
        "visit_date": days[keep],
    })
    return out, (days[-1] if len(days) else last_day)


class UniqueVisitor(_WindowBuffer):
    """Emit the least row of a device's first closed window of each day."""

    def __init__(self, window_ms: int = WINDOW_MS, time_zone: str = "UTC") -> None:
        super().__init__(window_ms)
        self.time_zone = time_zone

    def init_state(self, handle: StatefulProcessorHandle) -> None:
        self.last_day = handle.getValueState("last_day", "day string")

    def on_windows(self, due: pd.DataFrame) -> pd.DataFrame:
        firsts = due.drop_duplicates("w_end", keep="first")
        last = self.last_day.get()[0] if self.last_day.exists() else None
        out, last = _first_per_day(firsts, last, self.time_zone)
        if last is not None:
            self.last_day.update((str(last),))
        return out


def first_of_day(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The row of least ``ts`` of each device and day, of all rows of a partition (any order; a device's differ in ``ts``).

    Rows wait until there are as many as least rows, so each is sorted a few times at most
    and memory follows the number of devices and days.
    """
    least, waiting, n = None, [], 0

    def reduced() -> pa.Table:
        t = pa.Table.from_batches(waiting) if least is None else pa.concat_tables([least, pa.Table.from_batches(waiting)])
        t = t.sort_by([("mid", "ascending"), ("visit_date", "ascending"), ("ts", "ascending")]).combine_chunks()
        other = pc.or_(*[pc.not_equal(t[c].slice(1), t[c].slice(0, len(t) - 1)) for c in ("mid", "visit_date")])
        return t.filter(pa.chunked_array([[True], *other.chunks], pa.bool_()))

    for b in batches:
        if b.num_rows:
            waiting.append(b)
            n += b.num_rows
        if n >= max(FIRST_OF_DAY_ROWS, 0 if least is None else len(least)):
            least, waiting, n = reduced(), [], 0
    if waiting:
        least = reduced()
    if least is not None:
        yield from least.to_batches(FIRST_OF_DAY_ROWS)


class BounceBuckets(_OpenRows):
    """Rows of devices in short time buckets, decided as far as a bucket shows.

    Rows wait until the watermark passes the bucket's end. Each row of a device and bucket but the
    last then has its strict successor beside it. What the bucket cannot
    decide goes on: the first row (``head``, which may be an earlier bucket's
    successor) and the last row where that is an entry (``tail``). Rows at or below the
    watermark are late; they are given out as ``late``. A group has all rows of a device and
    bucket, of a part of the devices and buckets in one longer span.
    """

    FIELDS = BOUNCE_BUFFER_DDL

    def __init__(self, variant: str, bucket_ms: int) -> None:
        self.variant = variant
        self.bucket_ms = bucket_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm, fresh = timerValues.getCurrentWatermarkInMs(), []
        for r in rows:
            one = (r.mid, r.ts, r.seq, bool(r.is_entry), r.value, (r.bucket + 1) * self.bucket_ms)
            if r.ts > wm:
                fresh.append(one)
            else:
                yield _bounce_part("late", one, wm + 1)
        self.hold(fresh)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rows = sorted(self.take(timerValues.getCurrentWatermarkInMs()), key=device_order)
        for (_, end), own in groupby(rows, key=itemgetter(0, -1)):
            own = list(own)
            yield _bounce_part("head", (*own[0][:4], None), end)
            if self.variant == "reentry":  # a strict pattern is over with any successor
                for one, nxt in zip(own, own[1:]):
                    if one[3] and nxt[3]:
                        yield _bounce_part("out", one, end)
            if own[-1][3]:
                yield _bounce_part("tail", own[-1], end)


def _bounce_part(kind: str, row: tuple, at_ms: int) -> Row:
    return BOUNCE_PART(row[0], kind, *row[1:5], _time(at_ms))


class BouncePairs(_OpenRows):
    """Tails and heads of devices in spans of the limit's length.

    A tail belongs to its own span; a head also comes to the span before it,
    whose tails it can end. A span's tails are decided when every head within
    their limit has arrived. A group has all rows of a device and span, of a part of
    the devices and spans in one longer span.
    """

    FIELDS = f"{BOUNCE_BUFFER_DDL}, span bigint, is_tail boolean"

    def __init__(self, variant: str, gap_ms: int, bucket_ms: int) -> None:
        self.variant = variant
        self.gap_ms = gap_ms
        self.bucket_ms = bucket_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = []
        for r in rows:
            if r.kind in ("head", "tail"):
                until = (r.span + 2) * self.gap_ms + self.bucket_ms
                held.append((r.mid, r.ts, r.seq, r.is_entry, r.value, r.span, r.kind == "tail", until))
            else:
                yield BOUNCE_ROW(r.kind, r.value, r.seq, r.ts)
        self.hold(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rows = sorted(self.take(timerValues.getCurrentWatermarkInMs()), key=lambda r: (r[0], r[5], *row_order(r[1:3])))
        for _, own in groupby(rows, key=itemgetter(0, 5)):
            own = list(own)
            heads = [r for r in own if not r[6]]
            order = [row_order(h[1:3]) for h in heads]
            for _, ts, seq, _, value, _, is_tail, _ in own:
                if not is_tail:
                    continue
                at = bisect_right(order, row_order((ts, seq)))
                nxt = heads[at] if at < len(heads) else None
                if nxt is None or nxt[1] - ts >= self.gap_ms or (self.variant == "reentry" and nxt[3]):
                    yield BOUNCE_ROW("out", value, seq, ts)
