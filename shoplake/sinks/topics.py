"""Topic sinks: one fixed topic, or a topic per row.

Kafka is at-least-once in Spark (the original sink is transactional); rows
carry ``seq`` so a reader can drop repeats. The file form (one folder per
topic, parquet ``value, seq``) is exactly-once through the file sink's log or
the ``batch=<id>`` overwrite used in ``foreachBatch``. No Kafka jar ships with
this repository's test image, so the Kafka branches are untested here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shoplake.settings import TRIGGER_INTERVAL


def write_topic(df: DataFrame, topic: str, *, path: str | None = None,
                kafka: dict[str, str] | None = None, mode: str = "append") -> None:
    """Batch write of ``(value, seq)`` rows to one topic."""
    if kafka is not None:
        df.selectExpr("CAST(seq AS STRING) AS key", "value").write.format("kafka") \
            .options(**kafka).option("topic", topic).save()
        return
    if path is None:
        raise ValueError("either kafka options or a folder path is required")
    df.select("value", "seq").write.mode(mode).parquet(f"{path.rstrip('/')}/{topic}")


def write_dynamic_topics(df: DataFrame, *, path: str | None = None,
                         kafka: dict[str, str] | None = None, mode: str = "append") -> None:
    """Batch write of ``(topic, value, seq)`` rows, each to its own topic."""
    if kafka is not None:
        df.selectExpr("topic", "CAST(seq AS STRING) AS key", "value").write.format("kafka") \
            .options(**kafka).save()
        return
    if path is None:
        raise ValueError("either kafka options or a folder path is required")
    df.select("topic", "value", "seq").write.mode(mode).partitionBy("topic").parquet(path)


def start_topic_stream(df: DataFrame, topic: str, checkpoint: str, *, path: str | None = None,
                       kafka: dict[str, str] | None = None,
                       trigger: dict | None = None) -> StreamingQuery:
    """Streaming write of ``(value, seq)`` rows to one topic."""
    trig = trigger or {"processingTime": TRIGGER_INTERVAL}
    if kafka is not None:
        w = df.selectExpr("CAST(seq AS STRING) AS key", "value").writeStream.format("kafka") \
            .options(**kafka).option("topic", topic)
    elif path is not None:
        w = df.select("value", "seq").writeStream.format("parquet") \
            .option("path", f"{path.rstrip('/')}/{topic}")
    else:
        raise ValueError("either kafka options or a folder path is required")
    return w.option("checkpointLocation", checkpoint).outputMode("append").trigger(**trig).start()


def start_console(df: DataFrame, name: str = "console", truncate: bool = False) -> StreamingQuery:
    """Debug output of a stream (the original prints two of its jobs)."""
    return df.writeStream.format("console").option("truncate", str(truncate).lower()) \
        .outputMode("append").queryName(name).start()
