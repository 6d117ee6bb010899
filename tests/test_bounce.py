import random

import numpy as np
import pandas as pd
import pytest

from conftest import log_line, topic
from shoplake.operators import bounce, log_split
from shoplake.sources.inline import inline_topic


def _bounces(spark, raw, variant, gap=5000):
    pages = log_split.page_rows(log_split.parse_log_topic(raw))
    return sorted((r["mid"], r["ts"]) for r in bounce.bounces(pages, gap, variant).collect())


def test_inline_fixture_variant_a(spark):
    assert _bounces(spark, inline_topic(spark), "strict") == [("101", 11000)]


def test_inline_fixture_variant_b(spark):
    assert _bounces(spark, inline_topic(spark), "reentry") == [("101", 10000), ("101", 11000)]


@pytest.mark.parametrize("variant", ["strict", "reentry"])
def test_limit_is_exclusive(spark, variant):
    lines = [
        log_line(1, 10_000, page="home"),
        log_line(1, 15_000, page="x", last="home"),   # exactly +5 s: entry timed out
        log_line(2, 10_000, page="home"),
        log_line(2, 14_999, page="x", last="home"),   # +4.999 s: completes, no bounce
    ]
    assert _bounces(spark, topic(spark, lines), variant) == [("1", 10_000)]


def test_empty_last_page_is_entry(spark):
    lines = [log_line(1, 1000, page="home", last=""), log_line(1, 2000, page="home", last="")]
    assert _bounces(spark, topic(spark, lines), "reentry") == [("1", 1000), ("1", 2000)]
    assert _bounces(spark, topic(spark, lines), "strict") == [("1", 2000)]


def test_equal_ts_ordered_by_seq(spark):
    lines = [log_line(1, 1000, page="home"), log_line(1, 1000, page="x", last="home")]
    assert _bounces(spark, topic(spark, lines), "strict") == []
    lines = [log_line(1, 1000, page="x", last="home"), log_line(1, 1000, page="home")]
    assert _bounces(spark, topic(spark, lines), "strict") == [("1", 1000)]


def _brute(df: pd.DataFrame, gap: int, variant: str):
    out = []
    for _, g in df.sort_values(["ts", "seq"]).groupby("mid"):
        rows = g.to_dict("records")
        for i, r in enumerate(rows):
            if not r["entry"]:
                continue
            nxt = rows[i + 1] if i + 1 < len(rows) else None
            within = nxt is not None and nxt["ts"] - r["ts"] < gap
            if not within or (variant == "reentry" and nxt["entry"]):
                out.append((r["mid"], r["ts"], r["seq"]))
    return sorted(out)


@pytest.mark.parametrize("variant", ["strict", "reentry"])
def test_next_within_matches_brute_force_with_hot_key(spark, variant):
    rnd = random.Random(7)
    recs = []
    for seq in range(3000):
        mid = "hot" if rnd.random() < 0.4 else f"m{rnd.randint(0, 30)}"
        ts = rnd.randint(0, 200_000)
        entry = rnd.random() < 0.5
        recs.append((mid, ts, seq, entry))
    lines = [log_line(m, t, page="p", last=None if e else "q") for m, t, _, e in recs]
    got = sorted((r["mid"], r["ts"], r["seq"]) for r in bounce.bounces(
        log_split.page_rows(log_split.parse_log_topic(topic(spark, lines))), 5000, variant).collect())
    df = pd.DataFrame(recs, columns=["mid", "ts", "seq", "entry"])
    assert got == _brute(df, 5000, variant)


@pytest.mark.parametrize("bucket", [1, 7, 100, 4999])
def test_small_buckets_give_the_same_rows(spark, bucket):
    """A hot device inside one limit span is split by buckets far smaller than the limit."""
    rng = np.random.default_rng(bucket)
    n = 1500
    df = pd.DataFrame({
        "mid": np.where(rng.random(n) < 0.6, "hot", rng.integers(0, 20, n).astype(str)),
        "ts": np.where(rng.random(n) < 0.5, rng.integers(0, 5000, n), rng.integers(0, 200_000, n)),
        "seq": np.arange(n), "entry": rng.random(n) < 0.5,
    })
    rows = spark.createDataFrame(df)
    got = bounce.next_within(rows, "mid", 5000, ["entry"], bucket_ms=bucket).collect()
    want = {}
    for _, g in df.sort_values(["ts", "seq"]).groupby("mid"):
        r = g.to_dict("records")
        for a, b in zip(r, [*r[1:], None]):
            want[a["seq"]] = b["seq"] if b is not None and b["ts"] - a["ts"] < 5000 else None
    assert {r.seq: r.next_seq for r in got} == want
