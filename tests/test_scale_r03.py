"""Findings of round 3: sizes and times at scale."""

import glob
import json

from pyspark.sql import Row

from shoplake.operators import cdc, upsert
from shoplake.sinks import dims
from shoplake.sources.config_source import config_frame
from shoplake.streaming import jobs
from shoplake.streaming import processors as P


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def change_rows(spark, rows):
    text = [(json.dumps({"database": "shop", "table": t, "type": "insert", "data": d}), s) for t, d, s in rows]
    return cdc.clean_changes(spark.createDataFrame(text, "value string, seq bigint"))


def test_the_config_is_broadcast_whatever_the_planner_estimates(spark, scratch):
    """Parsed changes of a file are estimated far too small, and the planner broadcast them."""
    rows = [("t", {"id": str(i), "a": "x"}, i) for i in range(50)]
    text = [(json.dumps({"database": "shop", "table": t, "type": "insert", "data": d}), s) for t, d, s in rows]
    spark.createDataFrame(text, "value string, seq bigint").write.parquet(f"{scratch}/changes")
    config = config_frame(spark, [("t", "insert", "hbase", "d", "id,a", "id", None)])
    changes = cdc.clean_changes(spark.read.parquet(f"{scratch}/changes"))
    out = upsert.upsert_rows(cdc.dim_rows(cdc.route_changes(changes, config)))
    plan = plan_of(out)
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert sorted(r.pk[0] for r in out.collect()) == sorted(str(i) for i in range(50))


def test_changes_routed_as_of_a_position_are_not_broadcast(spark, scratch):
    text = [(json.dumps({"database": "shop", "table": "t", "type": "insert", "data": {"id": i}}), i) for i in range(50)]
    spark.createDataFrame(text, "value string, seq bigint").write.parquet(f"{scratch}/changes")
    config = config_frame(spark, [("t", "insert", "kafka", "d", "id", None, None)]).selectExpr("*", "'insert' as op", "10L as seq")
    out = cdc.route_changes_as_of(cdc.clean_changes(spark.read.parquet(f"{scratch}/changes")), config)
    assert "BroadcastHashJoin" not in plan_of(out)
    assert sorted(r.seq for r in out.collect()) == list(range(10, 50))


def test_many_target_tables_cost_no_folder_and_no_job_each(spark, scratch):
    """A hundred topics and dimension tables: the files follow the rows, and each table is read back."""
    rows = [(k, "insert", sink, f"{sink}_{k}", "id,a", "id", None) for k, sink in ((f"t{i}", ("kafka", "hbase")[i % 2]) for i in range(100))]
    config = config_frame(spark, rows)
    lines = [(json.dumps({"database": "shop", "table": f"t{i % 100}", "type": "insert", "data": {"id": i, "a": str(i)}}), i) for i in range(400)]
    spark.createDataFrame(lines, "value string, seq bigint").coalesce(1).write.parquet(f"{scratch}/in")
    for run in range(2):  # a second run adds nothing to the list of tables
        if run:
            spark.createDataFrame(lines[:200], "value string, seq bigint").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        raw = spark.readStream.schema("value string, seq bigint").parquet(f"{scratch}/in")
        jobs.await_job(jobs.start_db_detail(raw, lambda: config, f"{scratch}/out", f"{scratch}/ck", trigger={"availableNow": True}), 300)
    topics = spark.read.parquet(f"{scratch}/out/topics")
    assert topics.count() == 300 and topics.select("topic").distinct().count() == 50
    assert len(glob.glob(f"{scratch}/out/topics/*/*/")) == 0 and len(glob.glob(f"{scratch}/out/topics/*/*.parquet")) < 50
    assert len(glob.glob(f"{scratch}/out/dim_changelog/*/*/")) <= 2 * dims.TABLE_PARTS
    tables = dims.list_tables(spark, f"{scratch}/out")
    assert tables.count() == 50 == tables.select("sink_table").distinct().count()
    one = dims.current_table(spark, f"{scratch}/out", "hbase_t7")
    assert one.columns == ["id", "a"] and sorted(r.id for r in one.collect()) == ["107", "207", "307", "7"]


class _State:
    """A state variable and its group's timers, as a processor sees them."""

    def __init__(self):
        self.rows, self.value, self.timers = [], None, set()

    getListState = lambda self, name, ddl: self
    getValueState = lambda self, name, ddl: _Value()
    registerTimer = lambda self, ms: self.timers.add(ms)
    deleteTimer = lambda self, ms: self.timers.remove(ms)
    appendList = lambda self, rows: self.rows.extend(rows)
    get = lambda self: list(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def clear(self):
        self.rows = []


class _Value:
    value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_devices_share_a_group_with_one_timer():
    state, p = _State(), P.ClosedWindow(4)
    p.init(state)
    rows = [Row(mid=m, ts=t, seq=s, value=f"v{s}", w_end=(t // 5 + 1) * 5) for s, (m, t) in enumerate([("a", 12), ("b", 3), ("a", 2), ("a", 1), ("c", 30)])]
    assert list(p.handleInputRows((0, 1), iter(rows), _At(0))) == [] and state.timers == {5}
    state.timers.clear()
    out = [(r.mid, r.part, r.seq) for r in p.handleExpiredTimer((0, 1), _At(16), None)]
    assert out == [("a", 0, 3), ("a", 2, 2), ("a", 2, 0), ("b", 0, 1)]
    assert [r[0] for r in state.rows] == ["c"] and state.timers == {35}
    late = list(p.handleInputRows((0, 1), iter(rows[:1]), _At(16)))
    assert [(r.mid, r.part) for r in late] == [("a", -1)]


def test_upserts_are_folded_by_column_list_not_by_cell(spark):
    ddl = "sink_table string, pk array<string>, seq bigint, data map<string,string>, sink_columns string, sink_pk string"
    rows = [("d", ["1"], 1, {"id": "1", "a": "x", "b": "y"}, "id,a,b", "id"), ("d", ["1"], 2, {"id": "1", "a": "z"}, "id,a", "id")]
    out = upsert.current_rows(spark.createDataFrame(rows, ddl))
    assert "Generate" not in plan_of(out)
    assert [(r.seq, r.data) for r in out.collect()] == [(2, {"id": "1", "a": "z", "b": "y"})]
