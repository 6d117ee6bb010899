import json


from conftest import topic
from shoplake.operators import cdc, upsert
from shoplake.plans.routing import ROUTING_ROWS
from shoplake.sources.config_source import config_frame, config_latest


def change(table, typ, data, db="shop"):
    rec = {"database": db, "table": table, "type": typ, "ts": 1}
    if data is not None:
        rec["data"] = data
    return json.dumps(rec)


def test_clean_keeps_insert_update_and_bootstrap_insert(spark):
    lines = [
        change("signup", "insert", {"user_id": 1}),
        change("signup", "update", {"user_id": 1}),
        change("signup", "delete", {"user_id": 1}),
        change("signup", "insert", {}),
        change("signup", "bootstrap-start", {}),
        change("signup", "bootstrap-complete", None),
        change("signup", "bootstrap-insert", {"user_id": 2}),
        change(None, "insert", {"user_id": 3}),
        "broken {",
    ]
    got = cdc.clean_changes(topic(spark, lines)).select("seq", "type").collect()
    assert sorted((r.seq, r.type) for r in got) == [(0, "insert"), (1, "update"), (6, "insert")]


def test_prefix_strip_edits_values_too(spark):
    lines = [change("signup", "insert", {"user_id": 1, "note": "a bootstrap-b"})]
    row = cdc.clean_changes(topic(spark, lines)).collect()[0]
    assert row["data"]["note"].toPython() == "a b"


def test_route_filters_columns_and_drops_unmatched(spark):
    cfg = config_frame(spark, ROUTING_ROWS)
    lines = [
        change("purchase", "update", {"event_id": 5, "user_id": 9, "value": 1.5}),
        change("signup", "insert", {"event_id": 6, "user_id": 9, "value": 2.0}),
        change("view", "insert", {"event_id": 7}),
        change("click", "insert", {"event_id": 8}),
    ]
    routed = cdc.route_changes(cdc.clean_changes(topic(spark, lines)), cfg)
    topics, dims = cdc.split_routes(routed)
    t = topics.collect()
    assert len(t) == 1 and t[0]["sink_table"] == "dwd_purchase_upd"
    assert {k: float(v.toPython()) for k, v in t[0]["data"].items()} == {"event_id": 5, "value": 1.5}
    d = dims.collect()
    assert len(d) == 1 and dict(d[0]["data"]) == {"user_id": "9", "value": "2.0"}
    assert routed.count() == 3  # the 'other' sink row is routed but goes to neither sink
    rec = cdc.topic_records(topics).collect()[0]
    assert rec["topic"] == "dwd_purchase_upd" and json.loads(rec["value"]) == {"event_id": 5, "value": 1.5}


def test_upsert_latest_replaces_whole_row(spark):
    cfg = config_frame(spark, ROUTING_ROWS)
    lines = [
        change("signup", "insert", {"user_id": 1, "value": 1.0}),
        change("signup", "update", {"user_id": 1}),               # value absent -> null
        change("signup", "insert", {"user_id": 2, "value": 3.0}),
    ]
    dims = cdc.dim_rows(cdc.route_changes(cdc.clean_changes(topic(spark, lines)), cfg))
    cur = upsert.current_rows(upsert.upsert_rows(dims))
    got = sorted((r["pk"][0], r["data"].get("value"), r["seq"]) for r in cur.collect())
    assert got == [("1", None, 1), ("2", "3.0", 2)]


def test_table_schema_from_first_row(spark):
    cfg = config_frame(spark, [
        ("signup", "insert", "hbase", "dim_user", "id,name,age", None, " SALT_BUCKETS=4"),
    ])
    lines = [change("signup", "insert", {"id": 1, "name": "a"})]
    dims = cdc.dim_rows(cdc.route_changes(cdc.clean_changes(topic(spark, lines)), cfg))
    rows = sorted(tuple(r) for r in upsert.table_schemas(dims).collect())
    assert rows == [
        ("dim_user", 0, "id", "string", True, " SALT_BUCKETS=4"),
        ("dim_user", 1, "name", "string", False, " SALT_BUCKETS=4"),
        ("dim_user", 2, "age", "string", False, " SALT_BUCKETS=4"),
    ]


def test_config_latest_keeps_additions(spark):
    base = [(*r, "insert", i) for i, r in enumerate(ROUTING_ROWS)]
    changed = list(ROUTING_ROWS[0])
    changed[4] = "event_id"
    extra = [
        (*ROUTING_ROWS[0], "update_before", 10),
        (*changed, "update_after", 11),
        (*ROUTING_ROWS[4], "delete", 12),
    ]
    schema = ("source_table string, operate_type string, sink_type string, sink_table string, "
              "sink_columns string, sink_pk string, sink_extend string, op string, seq bigint")
    cur = config_latest(spark.createDataFrame(base + extra, schema))
    got = {(r.source_table, r.operate_type): r.sink_columns for r in cur.collect()}
    assert len(got) == 5  # the deleted row stays active
    assert got[("purchase", "insert")] == "event_id"


def test_routes_follow_the_config_of_the_change(spark):
    """A route that changes midway, a repeat, a delete that stays in force, positions on and beside a version's own."""
    from shoplake.schemas import TABLE_PROCESS_COLUMNS

    versions = [("t", "insert", "kafka", f"o{s}", "a", None, None, op, s) for op, s in
                (("insert", 10), ("update_before", 15), ("update_after", 20), ("delete", 30), ("insert", 10**9))]
    versions += [("u", "insert", "hbase", "d", "a", "a", None, "insert", 0), ("u", "update", "kafka", "w", "a", None, None, "insert", 25)]
    config = spark.createDataFrame(versions, ", ".join(f"{c} string" for c in TABLE_PROCESS_COLUMNS) + ", op string, seq bigint")
    at = [0, 9, 10, 11, 15, 19, 20, 21, 30, 31, 500]
    lines = [change(t, k, {"a": s}) for t in ("t", "u", "x") for k in ("insert", "update") for s in at]
    raw = spark.createDataFrame([(v, s) for v, s in zip(lines, at * 6)], "value string, seq bigint")
    want = []
    for t, k in (("t", "insert"), ("u", "insert"), ("u", "update")):
        own = sorted((v[8], v[3]) for v in versions if v[:2] == (t, k) and v[7] in ("insert", "update_after"))
        want += [(t, k, s, *max(o for o in own if o[0] <= s)) for s in at if any(o[0] <= s for o in own)]
    for buckets in (1, 7, 1024):
        got = cdc.route_changes_as_of(cdc.clean_changes(raw), config, buckets)
        assert sorted((r.source_table, r.operate_type, r.seq, r.config_seq, r.sink_table) for r in got.collect()) == sorted(want)
    assert not cdc.route_changes_as_of(cdc.clean_changes(raw.limit(0)), config).collect()
