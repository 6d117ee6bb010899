"""Stream = batch: replay a table as several ordered files, run the streaming
form with ``availableNow`` and compare with the batch form.

A sentinel row far in the future, under its own key, comes in a last file so
the watermark passes every window and pattern limit; it is removed from the
result.
"""

import datetime
import json
import os
import random
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from shoplake.functions.maps import text_of
from shoplake.operators import log_split, visitors, bounce, cdc, upsert
from shoplake.plans.dimensions import USER
from shoplake.plans.routing import ROUTING_ROWS
from shoplake.sources import adapters
from shoplake.sources.config_source import config_frame
from shoplake.sources.tables import read_table
from shoplake.sources.topics import read_topic
from shoplake.streaming import jobs

SENTINEL = "~sentinel"


def write_chunks(records, folder, n_files=4, sentinel=None):
    """Write (value, seq) records in seq order as n parquet files (+ sentinel file)."""
    os.makedirs(folder, exist_ok=True)
    records = sorted(records, key=lambda r: r[1])
    size = max(1, (len(records) + n_files - 1) // n_files)
    chunks = [records[i:i + size] for i in range(0, len(records), size)]
    if sentinel is not None:
        chunks.append([sentinel])
    t0 = time.time() - 1000
    for i, ch in enumerate(chunks):
        p = os.path.join(folder, f"chunk-{i:03d}.parquet")
        tbl = pa.table({"value": [c[0] for c in ch], "seq": pa.array([c[1] for c in ch], pa.int64())})
        pq.write_table(tbl, p)
        os.utime(p, (t0 + i, t0 + i))


def run_memory(df, name, checkpoint):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None, q.exception()
    return df.sparkSession.table(name)


def sentinel_line(ts):
    return json.dumps({"common": {"mid": SENTINEL}, "page": {"page_id": "s"}, "ts": ts})


def _raw_log(spark):
    return adapters.log_lines(read_table(spark, SF_SMOKE, "events"))


def _max_ts(spark):
    return spark.read.parquet(f"{SF_SMOKE}/events.parquet").select(
        F.unix_millis(F.max("ts").cast("timestamp"))).first()[0]


def test_repair_stream_equals_batch(spark, scratch):
    raw = _raw_log(spark)
    recs = [(r.value, r.seq) for r in raw.collect()]
    write_chunks(recs, f"{scratch}/ods_log", 4, (sentinel_line(_max_ts(spark) + 86_400_000), 10**9))
    stream = read_topic(spark, "ods_log", streaming=True, path=scratch, max_files_per_trigger=1)
    out = run_memory(jobs.repaired_log_stream(stream), "repair_out", f"{scratch}/ck")
    got = sorted((r.seq, r.n) for r in out.where(F.col("mid") != SENTINEL)
                 .select("seq", text_of("common", "is_new").alias("n")).collect())
    batch = visitors.repair_new_visitor(log_split.parse_log_topic(raw))
    want = sorted((r.seq, r.n) for r in batch.select("seq", text_of("common", "is_new").alias("n")).collect())
    assert got == want and len(got) == raw.count()


def _page_topic(spark):
    raw = _raw_log(spark)
    pages = log_split.page_rows(visitors.repair_new_visitor(log_split.parse_log_topic(raw)))
    return log_split.detail_json(pages, log_split.PAGE)


def test_unique_visitor_stream_equals_batch(spark, scratch):
    pages_raw = _page_topic(spark)
    recs = [(r.value, r.seq) for r in pages_raw.collect()]
    write_chunks(recs, f"{scratch}/dwd_page", 4, (sentinel_line(_max_ts(spark) + 86_400_000), 10**9))
    stream = read_topic(spark, "dwd_page", streaming=True, path=scratch, max_files_per_trigger=1)
    out = run_memory(jobs.unique_visitor_stream(stream), "uv_out", f"{scratch}/ck")
    got = sorted((r.seq, r.visit_date) for r in out.collect() if r.seq != 10**9)
    batch = visitors.unique_visitors(log_split.parse_log_topic(pages_raw))
    want = sorted((r.seq, r.visit_date) for r in batch.collect())
    assert got == want
    stream = read_topic(spark, "dwd_page", streaming=True, path=scratch, max_files_per_trigger=1)
    out2 = run_memory(jobs.unique_visitor_stream(stream, reduce_in_jvm=False), "uv_out2", f"{scratch}/ck2")
    assert sorted((r.seq, r.visit_date) for r in out2.collect() if r.seq != 10**9) == want


@pytest.mark.parametrize("variant", ["strict", "reentry"])
def test_bounce_stream_equals_batch(spark, scratch, variant):
    gap = 6 * 3600 * 1000
    pages_raw = _page_topic(spark)
    recs = [(r.value, r.seq) for r in pages_raw.collect()]
    write_chunks(recs, f"{scratch}/dwd_page", 4, (sentinel_line(_max_ts(spark) + 10 * gap), 10**9))
    stream = read_topic(spark, "dwd_page", streaming=True, path=scratch, max_files_per_trigger=1)
    out = run_memory(jobs.bounce_stream(stream, variant, gap), f"bounce_{variant}", f"{scratch}/ck")
    got = sorted(r.seq for r in out.collect() if r.seq != 10**9)
    batch = bounce.bounces(log_split.parse_log_topic(pages_raw), gap, variant)
    want = sorted(r.seq for r in batch.collect())
    assert got == want and len(want) > 0


def test_inline_fixture_stream(spark, scratch):
    from shoplake.sources.inline import INLINE_PAGE_LINES

    recs = [(v, i) for i, v in enumerate(INLINE_PAGE_LINES)]
    write_chunks(recs, f"{scratch}/p", 2, (sentinel_line(10**9), 99))
    stream = read_topic(spark, "p", streaming=True, path=scratch, max_files_per_trigger=1)
    a = run_memory(jobs.bounce_stream(stream, "strict"), "inline_a", f"{scratch}/cka")
    assert sorted(r.ts for r in a.collect() if r.seq != 99) == [11000]
    stream = read_topic(spark, "p", streaming=True, path=scratch, max_files_per_trigger=1)
    b = run_memory(jobs.bounce_stream(stream, "reentry"), "inline_b", f"{scratch}/ckb")
    assert sorted(r.ts for r in b.collect() if r.seq != 99) == [10000, 11000]


def test_late_row_is_dropped_by_repair(spark, scratch):
    lines = [
        (json.dumps({"common": {"mid": "1"}, "page": {"page_id": "a"}, "ts": 100_000}), 0),
        (json.dumps({"common": {"mid": "2"}, "page": {"page_id": "a"}, "ts": 200_000}), 1),
        # arrives after the watermark passed its window: dropped
        (json.dumps({"common": {"mid": "1"}, "page": {"page_id": "a"}, "ts": 100_001}), 2),
    ]
    write_chunks(lines, f"{scratch}/l", 3, (sentinel_line(10**9), 99))
    stream = read_topic(spark, "l", streaming=True, path=scratch, max_files_per_trigger=1)
    q = (jobs.repaired_log_stream(stream).writeStream.format("memory").queryName("late_out")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    jobs.await_job(q, 300)
    out = spark.table("late_out")
    assert sorted(r.seq for r in out.collect() if r.seq != 99) == [0, 1]


def test_order_wide_stream_equals_batch(spark, scratch):
    win = 30 * 86_400_000
    o_raw = adapters.order_info_lines(read_table(spark, SF_SMOKE, "orders"))
    d_raw = adapters.order_detail_lines(read_table(spark, SF_SMOKE, "lineitem"))
    write_chunks([(r.value, r.seq) for r in o_raw.collect()], f"{scratch}/o", 2)
    write_chunks([(r.value, r.seq) for r in d_raw.collect()], f"{scratch}/d", 2)
    cust = read_table(spark, SF_SMOKE, "customer")
    os_ = read_topic(spark, "o", streaming=True, path=scratch)
    ds_ = read_topic(spark, "d", streaming=True, path=scratch)
    out = run_memory(jobs.order_wide_stream(os_, ds_, [(USER, cust)], -win, win), "wide_out", f"{scratch}/ck")
    got = sorted((r.order_id, r.detail_id, r.user_name) for r in out.collect())
    from shoplake.operators import order_wide as ow
    b = ow.interval_join(ow.with_event_time(ow.parse_order_info(o_raw)),
                         ow.with_event_time(ow.parse_order_detail(d_raw)), -win, win)
    b = ow.enrich_dims(b, [(USER, cust)])
    want = sorted((r.order_id, r.detail_id, r.user_name) for r in b.collect())
    assert got == want and len(want) > 0


def test_db_detail_stream_equals_batch(spark, scratch):
    raw = adapters.change_lines(read_table(spark, SF_SMOKE, "events"))
    write_chunks([(r.value, r.seq) for r in raw.collect()], f"{scratch}/ods_db", 3)
    stream = read_topic(spark, "ods_db", streaming=True, path=scratch, max_files_per_trigger=1)
    q = jobs.start_db_detail(stream, lambda: config_frame(spark, ROUTING_ROWS), f"{scratch}/out",
                             f"{scratch}/ck", trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    routed = cdc.route_changes(cdc.clean_changes(raw), config_frame(spark, ROUTING_ROWS))
    topics = spark.read.parquet(f"{scratch}/out/topics")
    assert topics.count() == cdc.topic_rows(routed).count()
    cur = jobs.read_dim_current(spark, f"{scratch}/out")
    want = upsert.current_rows(upsert.upsert_rows(cdc.dim_rows(routed)))
    assert sorted((r.sink_table, tuple(r.pk), r.seq) for r in cur.collect()) == \
        sorted((r.sink_table, tuple(r.pk), r.seq) for r in want.collect())
    from shoplake.sinks import dims as dim_sink
    table = dim_sink.current_table(spark, f"{scratch}/out", "dim_user")
    assert table.columns == ["user_id", "value"] and table.count() == want.count()
    upto = dim_sink.compact(spark, f"{scratch}/out")
    assert upto == 2 and dim_sink.newest_snapshot(spark, f"{scratch}/out") == 2
    again = jobs.read_dim_current(spark, f"{scratch}/out")
    assert sorted((r.sink_table, tuple(r.pk), r.seq) for r in again.collect()) == \
        sorted((r.sink_table, tuple(r.pk), r.seq) for r in want.collect())


def test_log_detail_fanout_and_landing(spark, scratch):
    raw = _raw_log(spark)
    recs = [(r.value, r.seq) for r in raw.collect()]
    write_chunks(recs, f"{scratch}/ods_log", 2, (sentinel_line(_max_ts(spark) + 86_400_000), 10**9))
    stream = read_topic(spark, "ods_log", streaming=True, path=scratch, max_files_per_trigger=1)
    q = jobs.start_log_detail(stream, f"{scratch}/dwd", f"{scratch}/ck", trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    parts = log_split.split_log(visitors.repair_new_visitor(log_split.parse_log_topic(raw)))
    for name, kind in (("dwd_start", "start"), ("dwd_page", "page"), ("dwd_display", "display")):
        got = spark.read.parquet(f"{scratch}/dwd/{name}").where(F.col("seq") != 10**9).count()
        assert got == parts[kind].count(), name
    stream = read_topic(spark, "ods_log", streaming=True, path=scratch)
    from shoplake.operators.landing import landing_day_of_event
    lq = jobs.start_landing(stream, f"{scratch}/landing", f"{scratch}/ck2", day=landing_day_of_event(),
                            trigger={"availableNow": True})
    lq.awaitTermination(300)
    assert lq.exception() is None
    landed = spark.read.text(f"{scratch}/landing")
    assert landed.count() == len(recs) + 1
    assert landed.select("landing_date").distinct().count() == 31  # 30 days + sentinel day


def test_restart_from_checkpoint_keeps_state(spark, scratch):
    """Stop after part of the input, restart on the same checkpoint: the
    processor's state (seen devices, buffered windows) survives."""
    raw = _raw_log(spark)
    recs = sorted(((r.value, r.seq) for r in raw.collect()), key=lambda r: r[1])
    half = len(recs) // 2
    write_chunks(recs[:half], f"{scratch}/in/ods_log", 2)
    out_path, ck = f"{scratch}/out", f"{scratch}/ck"

    def run():
        stream = read_topic(spark, "ods_log", streaming=True, path=f"{scratch}/in", max_files_per_trigger=1)
        df = jobs.repaired_log_stream(stream).select("seq", text_of("common", "is_new").alias("is_new"),
                                                     "mid")
        q = jobs.start_to_parquet(df, out_path, ck, "restart", trigger={"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    # second half arrives later, in new files, plus the sentinel
    folder = f"{scratch}/in/ods_log"
    rest = recs[half:]
    t0 = time.time()
    for i, ch in enumerate([rest[: len(rest) // 2], rest[len(rest) // 2:],
                            [(sentinel_line(_max_ts(spark) + 86_400_000), 10**9)]]):
        p = os.path.join(folder, f"later-{i:03d}.parquet")
        pq.write_table(pa.table({"value": [c[0] for c in ch], "seq": pa.array([c[1] for c in ch], pa.int64())}), p)
        os.utime(p, (t0 + i, t0 + i))
    run()
    got = sorted((r.seq, r.is_new) for r in spark.read.parquet(out_path).where(F.col("mid") != SENTINEL).collect())
    batch = visitors.repair_new_visitor(log_split.parse_log_topic(raw))
    want = sorted((r.seq, r.n) for r in batch.select("seq", text_of("common", "is_new").alias("n")).collect())
    assert got == want


def test_out_of_order_within_watermark(spark, scratch):
    """Rows arriving out of order by less than the 3 s bound give the batch result."""
    lines = [
        (json.dumps({"common": {"mid": "101"}, "page": {"page_id": "home"}, "ts": 11000}), 1),
        (json.dumps({"common": {"mid": "101"}, "page": {"page_id": "home"}, "ts": 10000}), 0),
        (json.dumps({"common": {"mid": "102"}, "page": {"page_id": "good_list", "last_page_id": "home"},
                     "ts": 14000}), 3),
        (json.dumps({"common": {"mid": "102"}, "page": {"page_id": "home"}, "ts": 12000}), 2),
        (json.dumps({"common": {"mid": "102"}, "page": {"page_id": "good_list", "last_page_id": "detail"},
                     "ts": 50000}), 4),
    ]
    folder = f"{scratch}/p"
    os.makedirs(folder)
    t0 = time.time() - 100
    for i, ch in enumerate([lines[0:2], lines[2:4], lines[4:], [(sentinel_line(10**9), 99)]]):
        p = os.path.join(folder, f"c{i}.parquet")
        pq.write_table(pa.table({"value": [c[0] for c in ch], "seq": pa.array([c[1] for c in ch], pa.int64())}), p)
        os.utime(p, (t0 + i, t0 + i))
    for variant, want in (("strict", [11000]), ("reentry", [10000, 11000])):
        stream = read_topic(spark, "p", streaming=True, path=scratch, max_files_per_trigger=1)
        out = run_memory(jobs.bounce_stream(stream, variant), f"ooo_{variant}", f"{scratch}/ck_{variant}")
        assert sorted(r.ts for r in out.collect() if r.seq != 99) == want


def lines_of(rows):
    """``(mid, ts, entry, seq)`` as page-log lines."""
    return [(json.dumps({"common": {"mid": str(m)}, "page": {"page_id": "p", **({} if e else {"last_page_id": "q"})}, "ts": t}), s) for m, t, e, s in rows]


def write_parts(parts, folder):
    """One file, and so one micro-batch, per part."""
    os.makedirs(folder, exist_ok=True)
    t0 = time.time() - 1000
    for i, ch in enumerate(parts):
        p = os.path.join(folder, f"c{i:03d}.parquet")
        pq.write_table(pa.table({"value": [c[0] for c in ch], "seq": pa.array([c[1] for c in ch], pa.int64())}), p)
        os.utime(p, (t0 + i, t0 + i))


@pytest.mark.parametrize("variant", ["strict", "reentry"])
def test_bounce_stream_splits_a_hot_device(spark, scratch, variant):
    """One device holds 40 % of the rows, over several micro-batches and many time buckets; ties and exact limits."""
    rng = random.Random(7)
    rows = []
    for s in range(600):
        mid = "hot" if rng.random() < 0.4 else f"m{rng.randint(0, 40)}"
        rows.append((mid, 1_000_000 + rng.choice([0, 1, 250, 1250]) + 1250 * rng.randint(0, 150), rng.random() < 0.5, s))
    rows += [("edge", 1_300_000, True, 1000), ("edge", 1_305_000, False, 1001), ("edge2", 1_300_000, True, 1002), ("edge2", 1_304_999, False, 1003)]
    rows.sort(key=lambda r: r[1])
    parts = [lines_of(rows[a : a + 130]) for a in range(0, len(rows), 130)]
    for p in parts:
        rng.shuffle(p)
    write_parts([*parts, [(sentinel_line(10**10), 10**9)]], f"{scratch}/p")
    stream = read_topic(spark, "p", streaming=True, path=scratch, max_files_per_trigger=1)
    out = run_memory(jobs.bounce_stream(stream, variant), f"hot_{variant}", f"{scratch}/ck")
    want = []
    for mid in {r[0] for r in rows}:
        own = sorted((t, s, e) for m, t, e, s in rows if m == mid)
        for (t, s, e), n in zip(own, [*own[1:], None]):
            if e and (n is None or n[0] - t >= 5000 or (variant == "reentry" and n[2])):
                want.append(s)
    assert sorted(r.seq for r in out.collect() if r.seq != 10**9) == sorted(want)
    assert not os.path.exists(f"{scratch}/_state")


def test_bounce_stream_gives_out_late_rows(spark, scratch):
    parts = [lines_of([(1, 100_000, True, 0)]), lines_of([(2, 200_000, True, 1)]), lines_of([(1, 101_000, True, 2), (2, 197_500, False, 3)]), [(sentinel_line(10**10), 99)]]
    write_parts(parts, f"{scratch}/p")
    counter = jobs.LateRows("late")
    spark.streams.addListener(counter)
    try:
        stream = read_topic(spark, "p", streaming=True, path=scratch, max_files_per_trigger=1)
        out = run_memory(jobs.bounce_parts_stream(stream, "reentry"), "late", f"{scratch}/ck").collect()
        deadline = time.time() + 20
        while time.time() < deadline and counter.dropped.get("late", 0) + sum(r.kind == "late" for r in out) < 1:
            time.sleep(0.5)  # progress arrives on its own thread
    finally:
        spark.streams.removeListener(counter)
    assert counter.dropped.get("late", 0) + sum(r.kind == "late" for r in out) == 1  # 101 000; 197 500 is in time
    assert sorted(r.seq for r in out if r.kind == "out" and r.seq != 99) == [0, 1]


def test_repair_drops_a_row_within_the_lag_of_its_window(spark, scratch):
    """Window [100, 105) s fires when the watermark reaches 105 s. A row just after that is late, one before it is not."""
    def line(mid, ts, seq):
        return (json.dumps({"common": {"mid": str(mid)}, "page": {"page_id": "a"}, "ts": ts}), seq)

    parts = [[line(1, 103_000, 0)], [line(2, 107_900, 1)], [line(1, 102_000, 2)],  # watermark 104.9 s: in time, and now first
             [line(2, 108_000, 3)], [line(1, 101_000, 5)],  # watermark 105 s: the window fires
             [line(2, 108_001, 4)], [line(1, 101_500, 6)],
             [(sentinel_line(10**10), 99)]]
    write_parts(parts, f"{scratch}/l")
    counter = jobs.LateRows("lag")
    spark.streams.addListener(counter)
    try:
        stream = read_topic(spark, "l", streaming=True, path=scratch, max_files_per_trigger=1)
        out = run_memory(jobs.repaired_parts_stream(stream), "lag", f"{scratch}/ck").collect()
        tagged = [r.seq for r in out if r.is_new is None]
        deadline = time.time() + 20
        while time.time() < deadline and counter.dropped.get("lag", 0) + len(tagged) < 2:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(counter)
    assert sorted((r.seq, r.is_new) for r in out if r.seq not in (5, 6, 99)) == [(0, "0"), (1, "1"), (2, "1"), (3, "0"), (4, "0")]
    # one is late for the processor right after its window fired, one for Spark a micro-batch later
    assert tagged == [5] and counter.dropped["lag"] == 1


def test_repair_stream_splits_a_hot_device(spark, scratch):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"m{rng.randint(0, 30)}", 1_000_000 + 40 * s, True, s) for s in range(700)]
    parts = [lines_of(rows[a : a + 200]) for a in range(0, len(rows), 200)]
    write_parts([*parts, [(sentinel_line(10**10), 10**9)]], f"{scratch}/l")
    stream = read_topic(spark, "l", streaming=True, path=scratch, max_files_per_trigger=1)
    out = run_memory(jobs.repaired_log_stream(stream), "hot_repair", f"{scratch}/ck")
    first = {}
    for m, t, _, s in rows:
        first.setdefault(m, s)
    got = {r.seq: r.n for r in out.select("seq", text_of("common", "is_new").alias("n")).collect() if r.seq != 10**9}
    assert got == {s: "1" if first[m] == s else "0" for m, _, _, s in rows}


def test_log_detail_stream_equals_batch_after_a_restart(spark, scratch):
    """Stop after half the input, restart on the same checkpoint: open windows and seen devices are in Spark's state."""
    raw = _raw_log(spark)
    recs = sorted(((r.value, r.seq) for r in raw.collect()), key=lambda r: json.loads(r[0])["ts"])
    half = len(recs) // 2
    folder = f"{scratch}/in/ods_log"

    def run():
        stream = read_topic(spark, "ods_log", streaming=True, path=f"{scratch}/in", max_files_per_trigger=1)
        jobs.await_job(jobs.start_log_detail(stream, f"{scratch}/dwd", f"{scratch}/ck", trigger={"availableNow": True}), 300)

    write_parts([recs[: half // 2], recs[half // 2 : half]], folder)
    run()
    for i, ch in enumerate([recs[half:], [(sentinel_line(_max_ts(spark) + 86_400_000), 10**9)]]):
        pq.write_table(pa.table({"value": [c[0] for c in ch], "seq": pa.array([c[1] for c in ch], pa.int64())}), f"{folder}/later-{i}.parquet")
        os.utime(f"{folder}/later-{i}.parquet", (time.time() + i, time.time() + i))
    run()
    parts = log_split.split_log(visitors.repair_new_visitor(log_split.parse_log_topic(raw)))
    page = log_split.parse_log_topic(spark.read.parquet(f"{scratch}/dwd/dwd_page").where(F.col("seq") != 10**9))
    want = sorted((r.seq, r.n) for r in parts["page"].select("seq", text_of("common", "is_new").alias("n")).collect())
    assert sorted((r.seq, r.n) for r in page.select("seq", text_of("common", "is_new").alias("n")).collect()) == want
    for name, kind in (("dwd_start", "start"), ("dwd_display", "display")):
        assert spark.read.parquet(f"{scratch}/dwd/{name}").where(F.col("seq") != 10**9).count() == parts[kind].count(), name


def test_order_wide_stream_by_time_equals_batch(spark, scratch):
    win = 30 * 86_400_000
    o_raw = adapters.order_info_lines(read_table(spark, SF_SMOKE, "orders"))
    d_raw = adapters.order_detail_lines(read_table(spark, SF_SMOKE, "lineitem"))
    # arrival in create-time order, several files per side
    from shoplake.operators import order_wide as ow
    o_sorted = ow.parse_order_info(o_raw).select("create_ts").toPandas()
    o_recs = sorted(((r.value, r.seq) for r in o_raw.collect()), key=lambda r: json.loads(r[0])["create_time"])
    d_recs = sorted(((r.value, r.seq) for r in d_raw.collect()), key=lambda r: json.loads(r[0])["create_time"])
    assert len(o_sorted) == len(o_recs)

    def write_sorted(recs, folder, n):
        os.makedirs(folder, exist_ok=True)
        size = (len(recs) + n - 1) // n
        t0 = time.time() - 1000
        for i in range(n):
            ch = recs[i * size:(i + 1) * size]
            p = os.path.join(folder, f"c{i:03d}.parquet")
            pq.write_table(pa.table({"value": [c[0] for c in ch], "seq": pa.array([c[1] for c in ch], pa.int64())}), p)
            os.utime(p, (t0 + i, t0 + i))

    write_sorted(o_recs, f"{scratch}/o", 3)
    write_sorted(d_recs, f"{scratch}/d", 3)
    cust = read_table(spark, SF_SMOKE, "customer")
    os_ = read_topic(spark, "o", streaming=True, path=scratch, max_files_per_trigger=1)
    ds_ = read_topic(spark, "d", streaming=True, path=scratch, max_files_per_trigger=1)
    # each side arrives in time order, so the 3 s delay drops nothing
    out = run_memory(jobs.order_wide_stream(os_, ds_, [(USER, cust)], -win, win), "wide_by_time", f"{scratch}/ck")
    got = sorted((r.order_id, r.detail_id, r.user_name) for r in out.collect())
    b = ow.enrich_dims(ow.interval_join(ow.with_event_time(ow.parse_order_info(o_raw)),
                                        ow.with_event_time(ow.parse_order_detail(d_raw)), -win, win), [(USER, cust)])
    want = sorted((r.order_id, r.detail_id, r.user_name) for r in b.collect())
    assert got == want and len(want) > 0


def test_order_wide_stream_with_a_hot_order(spark, scratch):
    """One order has a third of all lines, spread over its interval and beyond; both ends of the interval count."""
    rng = random.Random(5)

    def at(ms):
        return datetime.datetime.fromtimestamp(1_600_000_000 + ms / 1000, datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")

    orders = [{"id": i, "create_time": at(1000 * 7 * i)} for i in range(1, 60)]
    details = [{"id": 1000 + j, "order_id": 30 if j % 3 == 0 else rng.randint(1, 70), "create_time": at(1000 * rng.randint(0, 420))} for j in range(600)]
    details += [{"id": 5000 + d, "order_id": 30, "create_time": at(1000 * (210 + d))} for d in (-6, -5, 5, 6)]
    cuts = [at(1000 * 420 * i // 4) for i in range(1, 4)] + ["9"]
    for name, recs in (("o", orders), ("d", details)):
        parts, low = [], ""
        for cut in cuts:
            parts.append([(json.dumps(r), n) for n, r in enumerate(recs) if low < r["create_time"] <= cut])
            low = cut
        write_parts(parts, f"{scratch}/{name}")
    src = {n: read_topic(spark, n, streaming=True, path=scratch, max_files_per_trigger=1) for n in ("o", "d")}
    out = run_memory(jobs.order_wide_stream(src["o"], src["d"], (), -5000, 5000), "hot_order", f"{scratch}/ck")
    seconds = {o["id"]: 7 * o["id"] for o in orders}
    base = datetime.datetime.fromtimestamp(1_600_000_000, datetime.timezone.utc).replace(tzinfo=None)
    want = []
    for d in details:
        t = (datetime.datetime.strptime(d["create_time"], "%Y-%m-%d %H:%M:%S") - base).total_seconds()
        if d["order_id"] in seconds and abs(t - seconds[d["order_id"]]) <= 5:
            want.append((d["order_id"], d["id"]))
    got = sorted((r.order_id, r.detail_id) for r in out.collect())
    assert got == sorted(want) and {5000 - 5, 5000 + 5} <= {d for _, d in got} and not {5000 - 6, 5000 + 6} & {d for _, d in got}
