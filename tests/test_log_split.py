import json

from pyspark.sql import functions as F

from conftest import log_line, topic
from shoplake.functions.maps import text_of
from shoplake.operators import log_split, visitors


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_start_goes_to_start_only(spark):
    raw = topic(spark, [log_line(1, 1000, page="home", start={"entry": "icon"},
                                 displays=[{"item": "1"}])])
    parts = log_split.split_log(log_split.parse_log_topic(raw))
    assert parts["start"].count() == 1
    assert parts["page"].count() == 0
    assert parts["display"].count() == 0


def test_page_with_displays_gives_both(spark):
    raw = topic(spark, [log_line(1, 1000, page="home", displays=[{"item": "1"}, {"item": "2"}])])
    parts = log_split.split_log(log_split.parse_log_topic(raw))
    assert parts["page"].count() == 1
    d = parts["display"].select(text_of("display", "item").alias("item"), "pos")
    assert _rows(d, "item", "pos") == [("1", 0), ("2", 1)]


def test_empty_displays_is_page_only(spark):
    raw = topic(spark, [log_line(1, 1000, page="home", displays=[])])
    parts = log_split.split_log(log_split.parse_log_topic(raw))
    assert parts["page"].count() == 1
    assert parts["display"].count() == 0


def test_null_start_counts_as_absent(spark):
    line = json.dumps({"common": {"mid": "1"}, "start": None, "page": {"page_id": "a"}, "ts": 5})
    parts = log_split.split_log(log_split.parse_log_topic(topic(spark, [line])))
    assert parts["start"].count() == 0
    assert parts["page"].count() == 1


def test_display_overlay_later_wins(spark):
    # display keys, then ts, then common, then page: page wins over display and common
    line = json.dumps({
        "common": {"mid": "7", "ch": "web", "page_id": "from_common"},
        "page": {"page_id": "home", "during_time": 30},
        "displays": [{"item": "9", "page_id": "from_display", "ts": 1, "ch": "d"}],
        "ts": 12345,
    })
    d = log_split.display_rows(log_split.parse_log_topic(topic(spark, [line]))).collect()[0]["display"]
    assert {k: v.toPython() for k, v in d.items()} == {
        "page_id": "home", "ts": 12345, "ch": "web", "item": "9", "mid": "7", "during_time": 30}


def test_displays_without_page_keep_common(spark):
    line = json.dumps({"common": {"mid": "3"}, "displays": [{"item": "1"}], "ts": 7})
    d = log_split.display_rows(log_split.parse_log_topic(topic(spark, [line]))).collect()
    assert len(d) == 1 and d[0]["display"]["mid"].toPython() == "3"


def test_malformed_rows_quarantined(spark):
    raw = topic(spark, ["not json", log_line(1, 10, page="a"), '{"common":{"mid":"1"}}'])
    assert log_split.parse_log_topic(raw).count() == 1
    assert log_split.malformed_log_rows(raw).count() == 2


RICH = {
    "common": {"mid": "1", "n": 3.5, "vc": 12, "geo": {"lat": 1.25, "tags": ["a", 2]}, "gone": None},
    "err": {"code": 7, "msg": "x"}, "actions": [{"id": 1}], "note": "12", "none": None, "ts": 5,
}


def published(spark, line, kind):
    log = visitors.repair_new_visitor(log_split.parse_log_topic(topic(spark, [json.dumps(line)])))
    return [json.loads(r.value) for r in log_split.detail_json(log_split.split_log(log)[kind], kind).collect()]


def test_published_records_keep_unknown_fields_and_json_types(spark):
    common = {k: v for k, v in RICH["common"].items() if k != "gone"} | {"is_new": "1"}
    want = {k: v for k, v in RICH.items() if k != "none"} | {"common": common}
    start = RICH | {"start": {"entry": "icon", "t": 5}}
    assert published(spark, start, "start") == [want | {"start": {"entry": "icon", "t": 5}}]
    shown = [{"item": "1", "order": 1, "z": None}, {"item": "2", "order": 2.5}]
    page = RICH | {"page": {"page_id": "a", "during_time": 30, "z": None}, "displays": shown}
    clean = [{"item": "1", "order": 1}, {"item": "2", "order": 2.5}]
    assert published(spark, page, "page") == [want | {"page": {"page_id": "a", "during_time": 30}, "displays": clean}]
    assert published(spark, page, "display") == [d | common | {"page_id": "a", "during_time": 30, "ts": 5} for d in clean]


def test_a_field_of_an_unexpected_type_passes_through(spark):
    line = RICH | {"page": {"page_id": "a"}, "displays": "odd"}
    assert published(spark, line, "page")[0]["displays"] == "odd"
    assert published(spark, line, "display") == []


def test_narrow_and_whole_parse_keep_the_same_rows(spark):
    lines = ['{"common":{"mid":7},"ts":"13"}', '{"common":"x","ts":1}', '{"common":{"mid":"a"},"ts":"soon"}', "null", "[]",
             '{"common":{"mid":"b"},"ts":1.0,"page":null}', '{"common":{"mid":null},"ts":1}']
    raw = topic(spark, lines)
    whole, narrow = log_split.parse_log_topic(raw), log_split.parse_log_topic(raw, ("page",))
    assert _rows(whole, "seq", "mid", "ts") == _rows(narrow, "seq", "mid", "ts") == _rows(log_split.log_keys(raw), "seq", "mid", "ts")
    assert _rows(whole, "seq") == [(0,), (5,)]
    assert _rows(log_split.malformed_log_rows(raw), "seq") == [(i,) for i in (1, 2, 3, 4, 6)]


def test_repair_first_row_only_and_tie_by_seq(spark):
    lines = [
        log_line(1, 2000, page="a", common_extra={"is_new": "0"}),
        log_line(1, 1000, page="b", common_extra={"is_new": "0"}),   # seq 1: first by ts
        log_line(1, 1000, page="c", common_extra={"is_new": "1"}),   # same ts, later seq
        log_line(2, 9000, page="d", common_extra={"is_new": "0"}),
    ]
    raw = topic(spark, lines)
    log = log_split.parse_log_topic(raw)
    fixed = visitors.repair_new_visitor(log, log_split.log_keys(raw))
    got = _rows(fixed.select("seq", text_of("common", "is_new").alias("n")), "seq", "n")
    assert got == [(0, "0"), (1, "1"), (2, "0"), (3, "1")]


def test_unique_visitor_per_day_across_midnight(spark):
    day = 86_400_000
    lines = [
        log_line(1, day - 2000, page="a"),
        log_line(1, day - 1000, page="b"),
        log_line(1, day + 10, page="c"),
        log_line(1, day + 5, page="d"),
        log_line(2, day + 5, page="e"),
    ]
    pages = log_split.page_rows(log_split.parse_log_topic(topic(spark, lines)))
    uv = visitors.unique_visitors(pages)
    assert _rows(uv, "mid", "visit_date", "seq") == [
        ("1", "1970-01-01", 0), ("1", "1970-01-02", 3), ("2", "1970-01-02", 4)]


def test_repeated_keys(spark):
    """At the top level the last one counts, as in the narrow parse; inside an object the record is malformed."""
    lines = ['{"common":{"mid":"a","x":1,"x":2},"page":{"page_id":"p"},"ts":1}',
             '{"common":{"mid":"b"},"page":{"page_id":"p"},"ts":1,"err":1,"err":2,"ts":9}']
    raw = topic(spark, lines)
    assert _rows(log_split.log_keys(raw), "seq", "ts") == _rows(log_split.parse_log_topic(raw), "seq", "ts") == [(1, 9)]
    assert _rows(log_split.malformed_log_rows(raw), "seq") == [(0,)]
    page = log_split.page_rows(log_split.parse_log_topic(raw))
    assert [json.loads(r.value)["err"] for r in log_split.detail_json(page, log_split.PAGE).collect()] == [2]
