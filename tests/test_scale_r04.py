"""What the round's findings asked for: less state work per row of the streams."""

import glob
import json
import random

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from shoplake.operators import order_wide as ow
from shoplake.session import ensure_session
from shoplake.sources.topics import read_topic
from shoplake.streaming import jobs
from shoplake.streaming import processors as P
from test_scale_r03 import _At, _State
from test_streaming import lines_of, run_memory, sentinel_line, write_parts


def test_an_order_is_copied_to_two_buckets_at_most(spark):
    day = 86_400_000
    orders = spark.range(0, 40).select(F.col("id"), (F.col("id") * 3 * day + 17).alias("create_ts"))
    got = orders.select("id", F.size(ow.touched_buckets(-30 * day, 30 * day, ow.BUCKETS)).alias("n")).collect()
    assert {r.n for r in got} == {2}


def test_state_settings_of_the_order_join(spark, scratch):
    """One store per partition and small commits, in a session that sets none of it."""
    s = ensure_session(spark.newSession())
    prefix = "spark.sql.streaming.stateStore.rocksdb"
    for name, value in (("changelogCheckpointing.enabled", "true"), ("trackTotalNumberOfRows", "false")):
        assert s.conf.get(f"{prefix}.{name}") == value
    at = "2020-01-0{} 00:00:00"
    parts = [[(json.dumps({"id": i, "order_id": i, "create_time": at.format(d)}), i)] for i, d in enumerate((1, 2, 3))]
    for name in ("o", "d"):
        write_parts(parts, f"{scratch}/{name}")
    o, d = (read_topic(s, n, streaming=True, path=scratch, max_files_per_trigger=1) for n in ("o", "d"))
    jobs.await_job(jobs.start_to_parquet(jobs.order_wide_stream(o, d), f"{scratch}/out", f"{scratch}/ck", "w", {"availableNow": True}), 300)
    assert sorted(r.order_id for r in s.read.parquet(f"{scratch}/out").collect()) == [0, 1, 2]
    assert not glob.glob(f"{scratch}/ck/state/0/0/*keyToNumValues*")  # no store of its own for a side's counts
    assert glob.glob(f"{scratch}/ck/state/0/*/*.changelog")


class _Seen:
    def __init__(self):
        self.known, self.asked = set(), []

    def containsKey(self, key):
        self.asked.append(key)
        return key in self.known

    def updateValue(self, key, value):
        self.known.add(key)

    getMapState = lambda self, name, key, value: self


def _frames(rows, size):
    return iter([pd.DataFrame(rows[a : a + size], columns=["mid", "ts", "seq", "value"]) for a in range(0, len(rows), size)])


def test_devices_share_a_group_of_the_new_visitor_flag():
    p = P.FirstOfDevice()
    flags = lambda frames: {s: f for df in frames for s, f in zip(df["seq"], df["is_first"])}
    rows = [(m, t, s, f"v{s}") for s, (m, t) in enumerate([("a", 7), ("b", 3), ("a", 2), ("a", 9), ("b", 3), ("a", 2)])]
    for size in (1, 2, 6):
        p.init(state := _Seen())
        assert flags(p.handleInputRows((5, 0), _frames(rows, size), None)) == {0: False, 1: True, 2: True, 3: False, 4: False, 5: False}
        assert state.asked == [("a",), ("b",)]
    assert flags(p.handleInputRows((5, 0), _frames([*rows[:2], ("c", 1, P.NO_SEQ, "v")], 2), None)) == {0: False, 1: False, P.NO_SEQ: True}
    assert flags(p.handleInputRows((0, 9), _frames(rows[:1], 1), None)) == {0: False}
    assert flags(p.handleInputRows((0, -1), _frames(rows[:1], 1), None)) == {0: None}


def test_rows_that_come_together_are_one_element_of_a_groups_state():
    """As ``test_devices_share_a_group_with_one_timer`` for the row form, with the least position and exact large ones."""
    state, p = _State(), P.ClosedWindowFrames(4)
    p.init(state)
    big = 2**60 + 1
    rows = [(m, t, s, f"v{s}", (t // 5 + 1) * 5) for s, (m, t) in zip((0, 1, 2, P.NO_SEQ, big), [("a", 12), ("b", 3), ("a", 2), ("a", 2), ("c", 30)])]
    frames = lambda rs: iter([pd.DataFrame(rs, columns=P.ClosedWindowFrames.FIELDS)])
    rows_of = lambda out: [(r.mid, r.part, r.seq, r.at.timestamp() * 1000) for df in out for r in df.itertuples()]
    assert list(p.handleInputRows((0, 1), frames(rows), _At(0))) == [] and state.timers == {5} and len(state.rows) == 1
    state.timers.clear()
    assert rows_of(p.handleExpiredTimer((0, 1), _At(16), None)) == [("a", 0, P.NO_SEQ, 5), ("a", 2, 2, 5), ("a", 2, 0, 15), ("b", 0, 1, 5)]
    assert [r[1] for r in state.rows] == [35] and state.timers == {35}
    assert rows_of(p.handleInputRows((0, 1), frames(rows[:1]), _At(16))) == [("a", -1, 0, 17)]
    state.timers.clear()
    assert rows_of(p.handleExpiredTimer((0, 1), _At(40), None)) == [("c", 0, big, 35)] and state.rows == []


def test_repair_of_rows_without_a_position_and_both_forms(spark, scratch):
    rows = [("a", 1000, 5), ("a", 1000, None), ("a", 2000, 3), ("b", 1500, None), ("b", 900_000, 2**60 + 1), ("c", 900_000, 9)]
    lines = [(lines_of([(m, t, True, 0)])[0][0], s) for m, t, s in rows]
    write_parts([lines[:4], lines[4:], [(sentinel_line(10**10), 99)]], f"{scratch}/l")
    for by_frames in (True, False):
        stream = read_topic(spark, "l", streaming=True, path=scratch, max_files_per_trigger=1)
        out = run_memory(jobs.repaired_parts_stream(stream, by_frames=by_frames), f"forms_{by_frames}".lower(), f"{scratch}/ck-{by_frames}")
        got = {(json.loads(r.value)["common"]["mid"], r.seq, r.is_new) for r in out.collect() if r.seq != 99}
        assert got == {("a", 5, "0"), ("a", None, "1"), ("a", 3, "0"), ("b", None, "1"), ("b", 2**60 + 1, "0"), ("c", 9, "1")}


def test_first_windows_of_a_day_are_reduced_in_bounded_steps(monkeypatch):
    monkeypatch.setattr(P, "FIRST_OF_DAY_ROWS", 8)
    rng = random.Random(4)
    rows = [(f"m{rng.randint(0, 9)}", f"2024-01-0{rng.randint(1, 5)}", t, t if t % 7 else None, f"v{t}") for t in rng.sample(range(1000), 300)]
    names = ["mid", "visit_date", "ts", "seq", "value"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[a : a + 11]], pa.schema([(n, pa.int64() if n in ("ts", "seq") else pa.string()) for n in names])) for a in range(0, 300, 11)]
    got = [tuple(r.values()) for b in P.first_of_day(iter([batches[0].slice(0, 0), *batches])) for r in b.to_pylist()]
    want = {}
    for r in sorted(rows, key=lambda r: r[2]):
        want.setdefault(r[:2], r)
    assert sorted(got, key=lambda r: r[:2]) == [want[k] for k in sorted(want)]
    assert list(P.first_of_day(iter([]))) == []


def test_unique_visitors_over_micro_batches_and_days(spark, scratch):
    """No Python call per device; a day's first window counts once, over micro-batches; a past day is forgotten."""
    hour, rng = 3_600_000, random.Random(6)
    rows = sorted((("hot" if rng.random() < 0.4 else f"m{rng.randint(0, 20)}", rng.randint(0, 72 * hour), True, s) for s in range(500)), key=lambda r: r[1])
    rows += [("edge", 72 * hour - 1, True, 1000), ("edge", 72 * hour, True, 1001)]  # the last of a day and the first of the next
    parts = [lines_of(rows[a : a + 120]) for a in range(0, len(rows), 120)]
    for p in parts:
        rng.shuffle(p)
    twice = [json.dumps({"common": {"mid": "twice", "is_new": n}, "page": {"page_id": "p"}, "ts": 71 * hour}) for n in "0100"]
    parts[-1] += [(t, 2000) for t in twice]  # one row that came four times, flagged once
    write_parts([*parts, [(sentinel_line(10**10), 99_999)]], f"{scratch}/p")
    stream = read_topic(spark, "p", streaming=True, path=scratch, max_files_per_trigger=1)
    q = (jobs.unique_visitor_stream(stream).writeStream.format("memory").queryName("uv_days").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    jobs.await_job(q, 300)
    states = [op.operatorName for op in q.lastProgress.stateOperators]
    assert sorted(states) == ["dedupe", "stateStoreSave"]
    want = {}
    for m, t, _, s in rows:
        want.setdefault((m, t // (24 * hour)), s)
    out = spark.table("uv_days").where("seq != 99999").collect()
    assert sorted(r.seq for r in out) == sorted([*want.values(), 2000])
    assert [r.value for r in out if r.seq == 2000] == [twice[1]]
    left = spark.read.format("statestore").option("operatorId", 0).load(f"{scratch}/ck").count()
    assert left <= 1  # the flush row's own day at most
