import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shoplake.session import build_session

    ckpt = tempfile.mkdtemp(prefix="shoplake-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="shoplake-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder."""
    from shoplake.session import local_path, scratch_dir

    d = local_path(scratch_dir(spark, "t"))
    os.makedirs(d, exist_ok=True)
    return d


def log_line(mid, ts, page=None, start=None, displays=None, common_extra=None, last=None):
    """One app-log JSON text for tests."""
    import json

    common = {"mid": str(mid), **(common_extra or {})}
    rec = {"common": common, "ts": ts}
    if start is not None:
        rec["start"] = start
    if page is not None:
        rec["page"] = {"page_id": page, **({"last_page_id": last} if last is not None else {})}
    if displays is not None:
        rec["displays"] = displays
    return json.dumps(rec)


def topic(spark, lines):
    return spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, seq bigint")
