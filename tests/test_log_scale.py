"""the log queries' join moves narrow rows, sorts none and spreads the work after it."""

import datetime
import json

from pyspark.sql import functions as F

from conftest import topic
from shoplake.operators import log_split, visitors
from shoplake.plans.queries import PAGE_FIELDS, q_log_display
from shoplake.sources import adapters

FIELDS = (*PAGE_FIELDS, "displays")
LINES = [
    {"common": {"mid": "1", "is_new": "1", "page_id": "c"}, "page": {"page_id": "p"}, "displays": [{"item": "9", "page_id": "d", "ts": 1}, {"item": None}], "ts": 5},
    {"common": {"mid": "1"}, "page": None, "displays": [{"item": "2"}], "ts": 4},
    {"common": {"mid": "2"}, "page": {"page_id": "p"}, "displays": None, "ts": 7},
    {"common": {"mid": "2"}, "page": {"page_id": "p"}, "displays": "x", "ts": 8},
    {"common": {"mid": "2"}, "page": {"page_id": "p"}, "displays": [1, {"item": "3"}], "ts": 9},
    {"common": {"mid": "2"}, "start": None, "page": "x", "displays": [{"item": "4"}, None], "ts": "10"},
    {"common": {"mid": "3"}, "start": {"entry": "icon"}, "page": {"page_id": "p"}, "displays": [{"item": "5"}], "ts": 1},
    {"common": {"mid": 4}, "start": "x", "ts": 2},
    {"common": {"mid": None}, "page": {"page_id": "p"}, "ts": 3},
    {"common": "x", "page": {"page_id": "p"}, "ts": 3},
]


def _events(spark, scratch, n=400):
    t0 = datetime.datetime(2024, 1, 1)
    kinds = ["view", "click", "signup", "purchase", "error"]
    rows = [(i, t0 + datetime.timedelta(seconds=i), i % 37, kinds[i % 5], 1.0, json.dumps({"k": i % 90})) for i in range(n)]
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/events.parquet")
    return rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fields_typed_after_the_join_give_the_rows_of_the_whole_parse(spark):
    raw = topic(spark, [json.dumps(x) for x in LINES])
    whole = log_split.split_log(visitors.repair_new_visitor(log_split.parse_log_topic(raw)))
    for kind, part in whole.items():
        log = log_split.of_kind(log_split.keyed_records(raw, FIELDS), kind)
        log = visitors.repair_new_visitor(log, log_split.log_keys(raw), typed=log_split.typed_records)
        late = log_split.split_log(log)[kind]
        text = lambda df: sorted((r.seq, r.value) for r in log_split.detail_json(df, kind).collect())  # noqa: B023, E731
        assert text(late) == text(part.drop("extra"))
        assert text(late)


def test_log_display_joins_narrow_rows_without_a_sort(spark, scratch):
    rows = _events(spark, scratch)
    out = q_log_display(spark, scratch)
    join, _, below = _plan(out).partition("ShuffledHashJoin")
    assert below and "MergeJoin" not in join and "Sort [" not in join + below
    assert "MapType" in join and "MapType" not in below  # fields get their types above the join
    assert "REPARTITION_BY_NUM" in below
    first = {}
    for i, _, user, *_ in rows:
        first.setdefault(user, i)
    want = sorted((i, j, "1" if first[user] == i else "0", str(k * 10 + j + 1), kind)
                  for i, _, user, kind, _, props in rows if kind != "signup" for k in [json.loads(props)["k"]] for j in range(k % 4))
    got = out.select("seq", "display_pos", "is_new", "item", "page_id").collect()
    assert sorted(tuple(r) for r in got) == want


def test_an_event_text_is_read_once(spark, scratch):
    _events(spark, scratch, 5)
    for rich in (False, True):
        assert _plan(adapters.log_lines(spark.read.parquet(f"{scratch}/events.parquet"), rich)).count("get_json_object") == 1


def test_display_overlay_keeps_the_order_of_keys(spark):
    line = {"common": {"mid": "1", "ch": "c", "ts": 3}, "page": {"page_id": "p", "ch": "q"}, "displays": [{"item": "9", "page_id": "d", "ts": 1}], "ts": 5}
    d = log_split.display_rows(log_split.parse_log_topic(topic(spark, [json.dumps(line)])))
    assert d.select(F.to_json("display").alias("t")).first().t == '{"item":"9","mid":"1","ts":3,"ch":"q","page_id":"p"}'
