"""SparkSession set-up shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

JOIN_STATE_FORMAT = "3"

# Session settings every operator relies on.
REQUIRED_CONF = {
    # runtime re-planning: partition coalescing, skew-join splitting,
    # size-based broadcast conversion
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # stateful processors (transformWithState) need the RocksDB store
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # a commit writes what changed, not new table files; no read before each write
    # just to count rows
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # a join keeps its state in one store per partition instead of four
    "spark.sql.streaming.join.stateFormatVersion": JOIN_STATE_FORMAT,
}


def build_session(
    master: str | None = None,
    app_name: str = "shoplake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    time_zone: str | None = "UTC",
) -> SparkSession:
    """Create (or reuse) a session with the settings the library needs.

    Event days and ``create_time`` texts follow ``time_zone``; None keeps the session's.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    cluster's ``spark.checkpoint.dir`` is kept as it is.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    return ensure_session(spark, time_zone)


def ensure_session(spark: SparkSession, time_zone: str | None = "UTC") -> SparkSession:
    """Apply the runtime-settable settings to an existing session (``time_zone`` None: keep its zone)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    if time_zone is not None:
        spark.conf.set("spark.sql.session.timeZone", time_zone)
    # transformWithState requires RocksDB; a new query takes the provider
    # from the session (a restarted one keeps the one in its checkpoint)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    # Spark's own default is never unset, and lower; a restarted query keeps the format in its checkpoint
    if int(spark.conf.get("spark.sql.streaming.join.stateFormatVersion")) < int(JOIN_STATE_FORMAT):
        spark.conf.set("spark.sql.streaming.join.stateFormatVersion", JOIN_STATE_FORMAT)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, changelogs and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder
    there). Only when it is unset on a local master, as in tests, a fresh
    scratch folder is created and registered; elsewhere executors would write
    to their own disks, so it must be set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # no classic SparkContext
            d = None
    if not d:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shoplake-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # a core setting some deployments refuse at run time
            pass
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:
            pass
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint folder."""
    import uuid

    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = [
    "build_session",
    "ensure_session",
    "checkpoint_root",
    "scratch_dir",
    "local_path",
]
