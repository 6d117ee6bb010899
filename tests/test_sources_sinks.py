from pyspark.sql import functions as F

from conftest import SF_SMOKE
from shoplake.plans.routing import ROUTING_ROWS
from shoplake.sinks import topics as topic_sink
from shoplake.sources import adapters
from shoplake.sources.config_source import config_frame, read_config
from shoplake.sources.tables import read_table
from shoplake.sources.topics import read_topic, read_topics


def test_topic_round_trip_batch(spark, scratch):
    raw = adapters.log_lines(read_table(spark, SF_SMOKE, "events"))
    topic_sink.write_topic(raw, "ods_log", path=scratch)
    back = read_topic(spark, "ods_log", path=scratch)
    assert back.columns == ["value", "seq"]
    assert back.count() == raw.count()
    both = read_topics(spark, ["ods_log"], path=scratch)
    assert set(both) == {"ods_log"}


def test_dynamic_topics_partition_by_topic(spark, scratch):
    df = spark.createDataFrame([("a", "{}", 1), ("b", "{}", 2), ("a", "{}", 3)],
                               "topic string, value string, seq bigint")
    topic_sink.write_dynamic_topics(df, path=scratch)
    got = spark.read.parquet(scratch).groupBy("topic").count().collect()
    assert sorted((r.topic, r["count"]) for r in got) == [("a", 2), ("b", 1)]


def test_topic_stream_sink(spark, scratch):
    raw = adapters.change_lines(read_table(spark, SF_SMOKE, "events"))
    topic_sink.write_topic(raw, "ods_db", path=f"{scratch}/in")
    stream = read_topic(spark, "ods_db", streaming=True, path=f"{scratch}/in")
    q = topic_sink.start_topic_stream(stream, "copy", f"{scratch}/ck", path=f"{scratch}/out",
                                      trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    assert read_topic(spark, "copy", path=f"{scratch}/out").count() == raw.count()


def test_config_snapshot_read(spark, scratch):
    config_frame(spark, ROUTING_ROWS).write.parquet(f"{scratch}/tp")
    cfg = read_config(spark, path=f"{scratch}/tp")
    assert cfg.columns == ["source_table", "operate_type", "sink_type", "sink_table",
                           "sink_columns", "sink_pk", "sink_extend"]
    assert cfg.where(F.col("sink_type") == "hbase").count() == 2


def test_empty_config_routes_nothing(spark):
    from shoplake.operators import cdc

    raw = adapters.change_lines(read_table(spark, SF_SMOKE, "events"))
    empty = config_frame(spark, [])
    assert cdc.route_changes(cdc.clean_changes(raw), empty).count() == 0


def test_changelog_config_loader_keeps_deleted_rows(spark, scratch):
    from shoplake.sources.config_source import changelog_config_loader

    schema = ("source_table string, operate_type string, sink_type string, sink_table string, "
              "sink_columns string, sink_pk string, sink_extend string, op string, seq bigint")
    rows = [(*r, "insert", i) for i, r in enumerate(ROUTING_ROWS)]
    rows.append((*ROUTING_ROWS[2], "delete", 9))
    spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/tp_changes")
    cfg = changelog_config_loader(spark, f"{scratch}/tp_changes")()
    assert cfg.count() == 5
    assert cfg.where(F.col("sink_table") == "dim_user").count() == 2


def test_job_launcher_runs_log_detail(spark, scratch):
    from shoplake.__main__ import main

    raw = adapters.log_lines(read_table(spark, SF_SMOKE, "events"))
    topic_sink.write_topic(raw, "ods_log", path=f"{scratch}/topics")
    main(["log-detail", "--topics-dir", f"{scratch}/topics", "--out", f"{scratch}/dwd",
          "--checkpoint", f"{scratch}/ck", "--once", "--by-batches"])
    pages = spark.read.parquet(f"{scratch}/dwd/dwd_page").count()
    starts = spark.read.parquet(f"{scratch}/dwd/dwd_start").count()
    # the last open windows stay open without later events
    assert 0 < pages + starts <= raw.count()
