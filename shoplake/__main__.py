"""Start one streaming job: ``python -m shoplake <job> [options]``.

Jobs: log-detail, db-detail, unique-visitor, bounce, order-wide, landing.
Sources are Kafka topics (``--kafka-bootstrap``) or parquet topic folders
(``--topics-dir``); outputs go to ``--out``. The checkpoint defaults to a
folder under the session's ``spark.checkpoint.dir``. A failed job raises.
"""

from __future__ import annotations

import argparse
import json

from shoplake import settings
from shoplake.operators import log_split
from shoplake.operators.order_wide import Dim, malformed_orders
from shoplake.session import build_session, scratch_dir
from shoplake.sinks.dims import read_dims
from shoplake.sources.config_source import read_config
from shoplake.sources.topics import read_topic
from shoplake.streaming import jobs

JOBS = ("log-detail", "db-detail", "unique-visitor", "bounce", "order-wide", "landing")


def _args(argv=None):
    p = argparse.ArgumentParser(prog="python -m shoplake")
    p.add_argument("job", choices=JOBS)
    p.add_argument("--out", required=True, help="output folder")
    p.add_argument("--checkpoint", help="checkpoint folder (default: under spark.checkpoint.dir)")
    p.add_argument("--kafka-bootstrap", help="Kafka bootstrap servers; else --topics-dir")
    p.add_argument("--topics-dir", help="folder of parquet topic folders (value, seq)")
    p.add_argument("--config-path", help="db-detail: parquet folder of the routing config")
    p.add_argument("--variant", default="reentry", choices=("strict", "reentry"), help="bounce variant")
    p.add_argument("--gap-ms", type=int, default=settings.BOUNCE_GAP_MS)
    p.add_argument("--once", action="store_true", help="process what is there, then stop")
    p.add_argument("--by-batches", action="store_true", help="accepted from older command lines, no effect: each job has one form")
    p.add_argument("--kafka-out", action="store_true",
                   help="write the output topics to Kafka (--kafka-bootstrap)")
    p.add_argument("--malformed", default="quarantine", choices=jobs.MALFORMED, help="what to do with malformed records")
    p.add_argument("--dims-root", help="order-wide: output folder of db-detail, whose dimension tables are joined")
    p.add_argument("--dims-config", help="order-wide: JSON list of {table, wide_key, columns, key}")
    p.add_argument("--time-zone", default="UTC", help="zone of days and create times")
    p.add_argument("--master", default=None)
    return p.parse_args(argv)


def main(argv=None) -> None:
    a = _args(argv)
    spark = build_session(a.master, app_name=f"shoplake-{a.job}", time_zone=a.time_zone)
    kafka = {"kafka.bootstrap.servers": a.kafka_bootstrap} if a.kafka_bootstrap else None

    def topic(name):
        return read_topic(spark, name, streaming=True, path=a.topics_dir, kafka=kafka)

    ck = a.checkpoint or scratch_dir(spark, f"ck-{a.job}")
    trigger = {"availableNow": True} if a.once else None
    kafka_out = kafka if a.kafka_out else None

    def dims():
        if not a.dims_root:
            return ()
        with open(a.dims_config) as f:
            return read_dims(spark, a.dims_root, [Dim(**d) for d in json.load(f)])

    def set_aside(name, malformed):
        return jobs.start_quarantine(topic(name), malformed, f"{a.out.rstrip('/')}/aside-{name}", f"{ck}-malformed-{name}", a.malformed, trigger)

    aside = []
    if a.job == "log-detail":
        aside.append(set_aside(settings.TOPIC_ODS_LOG, log_split.malformed_log_rows))
        q = jobs.start_log_detail(topic(settings.TOPIC_ODS_LOG), a.out, ck, trigger=trigger, kafka=kafka_out)
    elif a.job == "db-detail":
        if not a.config_path:
            raise SystemExit("db-detail needs --config-path")
        q = jobs.start_db_detail(topic(settings.TOPIC_ODS_DB), lambda: read_config(spark, path=a.config_path),
                                 a.out, ck, trigger=trigger, kafka=kafka_out, on_malformed=a.malformed)
    elif a.job == "unique-visitor":
        q = jobs.start_unique_visitor(topic(settings.TOPIC_DWD_PAGE), a.out, ck, trigger, kafka_out)
    elif a.job == "bounce":
        aside.append(set_aside(settings.TOPIC_DWD_PAGE, log_split.malformed_page_rows))
        q = jobs.start_bounce(topic(settings.TOPIC_DWD_PAGE), a.out, ck, a.variant, a.gap_ms, trigger, kafka_out)
    elif a.job == "order-wide":
        aside.append(set_aside(settings.TOPIC_DWD_ORDER_INFO, malformed_orders))
        aside.append(set_aside(settings.TOPIC_DWD_ORDER_DETAIL, lambda rows: malformed_orders(rows, details=True)))
        wide = jobs.order_wide_stream(topic(settings.TOPIC_DWD_ORDER_INFO), topic(settings.TOPIC_DWD_ORDER_DETAIL), dims())
        q = jobs.start_to_parquet(wide, a.out, ck, "order_wide", trigger=trigger)
    else:
        q = jobs.start_landing(topic(settings.TOPIC_ODS_LOG), a.out, ck, trigger=trigger)
    if aside and not a.once:
        spark.streams.awaitAnyTermination()  # raises when one fails
    for query in (*aside, q):
        jobs.await_job(query)


if __name__ == "__main__":
    main()
