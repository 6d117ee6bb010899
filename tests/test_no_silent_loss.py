"""Incomplete results raise; published and stored rows keep every configured field."""

import glob
import json
import re

import pytest
from pyspark.sql import functions as F

from conftest import log_line, topic
from shoplake.operators import cdc, log_split, order_wide, upsert, visitors
from shoplake.session import ensure_session
from shoplake.sinks import write_landing
from shoplake.sinks.dims import append_changelog, compact, read_current
from shoplake.sources.config_source import config_frame
from shoplake.streaming import jobs


def test_wait_limit_raises_and_stops(spark, scratch):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    q = rate.writeStream.format("noop").option("checkpointLocation", f"{scratch}/ck").start()
    with pytest.raises(TimeoutError):
        jobs.await_job(q, 1)
    assert not q.isActive


def test_missing_state_raises(spark, scratch):
    with pytest.raises(RuntimeError, match="missing"):
        jobs._read_state(spark, f"{scratch}/_state/carry/batch=3", "mid string")
    with pytest.raises(RuntimeError, match="missing"):
        jobs._seen_before(spark, scratch, 2)
    assert jobs._seen_before(spark, scratch, 0) is None


def change(table, kind, data, seq):
    return (json.dumps({"database": "shop", "table": table, "type": kind, "data": data}), seq)


def routed(spark, changes, config):
    raw = spark.createDataFrame(changes, "value string, seq bigint")
    return cdc.route_changes(cdc.clean_changes(raw), config_frame(spark, config))


def test_repeated_config_key_does_not_double_rows(spark):
    config = [("t", "insert", "kafka", "o", "a", None, None), ("t", "insert", "kafka", "o2", "a", None, None)]
    rows = routed(spark, [change("t", "insert", {"a": "1"}, 1)], config).collect()
    assert [r.sink_table for r in rows] == ["o2"]


def test_topic_records_omit_nulls(spark):
    config = [("t", "insert", "kafka", "o", "a,b", None, None)]
    r = cdc.topic_records(cdc.topic_rows(routed(spark, [change("t", "insert", {"a": "1", "b": None}, 1)], config))).first()
    assert json.loads(r.value) == {"a": "1"}


def test_upsert_keeps_columns_that_an_update_does_not_list(spark):
    config = [("t", "insert", "hbase", "d", "id,a,b", "id", None), ("t", "update", "hbase", "d", "id,a", "id", None)]
    changes = [
        change("t", "insert", {"id": "1", "a": "x", "b": "y"}, 1), change("t", "update", {"id": "1", "a": "z"}, 2),
        change("t", "insert", {"id": "2", "a": "p", "b": "q"}, 3), change("t", "insert", {"id": "2", "b": "r"}, 4),
    ]
    cur = upsert.current_rows(upsert.upsert_rows(cdc.dim_rows(routed(spark, changes, config))))
    assert {r.pk[0]: (r.data, r.seq) for r in cur.collect()} == {
        "1": ({"id": "1", "a": "z", "b": "y"}, 2), "2": ({"id": "2", "a": None, "b": "r"}, 4),
    }


def test_later_batch_wins_over_a_larger_position(spark, scratch):
    ddl = "sink_table string, pk array<string>, seq bigint, data map<string,string>, sink_columns string, sink_pk string"
    for batch, seq, v in ((0, 1 << 41, "old"), (1, 5, "new")):
        append_changelog(spark.createDataFrame([("d", ["1"], seq, {"id": "1", "v": v}, "id,v", "id")], ddl), scratch, batch)
    assert [r.data["v"] for r in read_current(spark, scratch).collect()] == ["new"]


def test_landing_files_follow_the_data(spark, scratch):
    raw = spark.range(0, 3000, 1, 8).select(F.col("id").cast("string").alias("value"), F.col("id").alias("seq"))
    write_landing(raw, f"{scratch}/land", day=F.concat(F.lit("2026-01-0"), F.col("seq") % 5 + 1))
    assert len(glob.glob(f"{scratch}/land/landing_date=*/part-*")) == 5  # not 8 tasks x 5 days
    assert sorted(int(r.value) for r in spark.read.text(f"{scratch}/land/*").collect()) == list(range(3000))


def test_read_after_compaction_folds_the_snapshot_with_later_batches(spark, scratch):
    ddl = "sink_table string, pk array<string>, seq bigint, data map<string,string>, sink_columns string, sink_pk string"
    rows = [
        (0, ("d", ["1"], 7, {"id": "1", "a": "x", "b": "y"}, "id,a,b", "id")),
        (1, ("d", ["1"], 3, {"id": "1", "a": "z"}, "id,a", "id")),
        (2, ("d", ["1"], 1, {"id": "1", "b": "w"}, "id,b", "id")),
    ]
    for batch, row in rows[:2]:
        append_changelog(spark.createDataFrame([row], ddl), scratch, batch)
    assert compact(spark, scratch) == 1
    assert [r.data for r in read_current(spark, scratch).collect()] == [{"id": "1", "a": "z", "b": "y"}]
    append_changelog(spark.createDataFrame([rows[2][1]], ddl), scratch, 2)
    cur = read_current(spark, scratch)
    assert [(r.data, r.seq) for r in cur.collect()] == [({"id": "1", "a": "z", "b": "w"}, 1)]
    assert re.search(r"PartitionFilters: \[[^]]*batch#\d+ > 1\)", cur._jdf.queryExecution().sparkPlan().toString())
    assert compact(spark, scratch) == 2 == compact(spark, scratch)
    assert [(r.data, r.seq) for r in read_current(spark, scratch).collect()] == [({"id": "1", "a": "z", "b": "w"}, 1)]


def run(query):
    jobs.await_job(query, 300)


def write_topic(spark, scratch, name, lines):
    spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, seq bigint").coalesce(1).write.parquet(f"{scratch}/{name}")
    return spark.readStream.schema("value string, seq bigint").parquet(f"{scratch}/{name}")


BAD_LOG = ["not json", log_line(1, 10_000, page="a"), '{"common":{"mid":"1"}}']


def test_malformed_log_records_are_set_aside_or_fail_the_job(spark, scratch):
    raw = write_topic(spark, scratch, "l", BAD_LOG)
    once = {"availableNow": True}
    run(jobs.start_quarantine(raw, log_split.malformed_log_rows, f"{scratch}/aside", f"{scratch}/c2", trigger=once))
    assert sorted(r.seq for r in spark.read.parquet(f"{scratch}/aside/malformed").collect()) == [0, 2]
    assert jobs.malformed_rows(spark, f"{scratch}/aside") == 2
    with pytest.raises(Exception, match="malformed"):
        run(jobs.start_quarantine(raw, log_split.malformed_log_rows, f"{scratch}/o3", f"{scratch}/c3", "fail", once))


def test_malformed_changes_and_orders_are_set_aside(spark, scratch):
    once = {"availableNow": True}
    changes = write_topic(spark, scratch, "c", ["{", change("t", "insert", {"a": 1}, 0)[0], change("t", "delete", {"a": 1}, 0)[0]])
    config = config_frame(spark, [("t", "insert", "kafka", "o", "a", None, None)])
    run(jobs.start_db_detail(changes, lambda: config, f"{scratch}/db", f"{scratch}/c1", trigger=once))
    assert jobs.malformed_rows(spark, f"{scratch}/db") == 1
    orders = write_topic(spark, scratch, "o", ['{"id":1,"create_time":"2021-01-01 00:00:00"}', '{"id":2,"create_time":"soon"}'])
    details = write_topic(spark, scratch, "d", ['{"id":5,"order_id":1,"create_time":"2021-01-01 00:00:01"}', "x", '{"order_id":1}'])
    run(jobs.start_quarantine(orders, order_wide.malformed_orders, f"{scratch}/ow", f"{scratch}/c2", trigger=once))
    run(jobs.start_quarantine(details, lambda r: order_wide.malformed_orders(r, details=True), f"{scratch}/dw", f"{scratch}/c3", trigger=once))
    assert jobs.malformed_rows(spark, f"{scratch}/ow") == 1 and jobs.malformed_rows(spark, f"{scratch}/dw") == 2
    run(jobs.start_to_parquet(jobs.order_wide_stream(orders, details), f"{scratch}/w", f"{scratch}/c4", "wide", once))
    assert [r.detail_id for r in spark.read.parquet(f"{scratch}/w").collect()] == [5]


def test_visitor_days_follow_the_time_zone(spark, scratch):
    zone = spark.conf.get("spark.sql.session.timeZone")
    hour = 3_600_000
    lines = [log_line(1, h * hour, page="p") for h in (1, 15, 17, 30)] + [log_line("z", 10**10, page="p")]
    try:
        ensure_session(spark, "Asia/Shanghai")  # the day changes at 16:00 UTC
        raw = topic(spark, lines)
        batch = visitors.unique_visitors(log_split.page_rows(log_split.parse_log_topic(raw))).where("mid = '1'")
        assert sorted((r.seq, r.visit_date) for r in batch.collect()) == [(0, "1970-01-01"), (2, "1970-01-02")]
        write_topic(spark, scratch, "p", lines)
        src = lambda: spark.readStream.schema("value string, seq bigint").parquet(f"{scratch}/p")
        run(jobs.start_unique_visitor(src(), scratch, f"{scratch}/c1", {"availableNow": True}))
        assert sorted(r.seq for r in spark.read.parquet(f"{scratch}/dwm_uv").collect()) == [0, 2]
        ensure_session(spark, None)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Shanghai"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_landing_also_publishes_the_lines(spark, scratch):
    raw = write_topic(spark, scratch, "in", BAD_LOG)
    run(jobs.start_landing_and_publish(raw, f"{scratch}/land", f"{scratch}/c", f"{scratch}/topics", trigger={"availableNow": True}))
    assert sorted(r.value for r in spark.read.text(f"{scratch}/land").collect()) == sorted(BAD_LOG)
    assert sorted(r.value for r in spark.read.parquet(f"{scratch}/topics/ods_log").collect()) == sorted(BAD_LOG)
