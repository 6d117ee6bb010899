"""Property tests: the distributed operators equal a plain sequential reading
of the rules on random small inputs (ties, exact limits, one dominant key)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import log_line, topic
from shoplake.operators import bounce, log_split, visitors

GAP = 10

rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["a", "a", "a", "b", "c"]),   # one dominant device
        st.integers(min_value=0, max_value=60),       # small range: many ties and exact gaps
        st.booleans(),                                # entry?
    ),
    min_size=1,
    max_size=40,
)


def _brute_bounces(recs, variant):
    df = pd.DataFrame(recs, columns=["mid", "ts", "entry", "seq"])
    out = []
    for _, g in df.sort_values(["ts", "seq"]).groupby("mid"):
        rows = g.to_dict("records")
        for i, r in enumerate(rows):
            if not r["entry"]:
                continue
            nxt = rows[i + 1] if i + 1 < len(rows) else None
            within = nxt is not None and nxt["ts"] - r["ts"] < GAP
            if not within or (variant == "reentry" and nxt["entry"]):
                out.append(r["seq"])
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_strategy, st.sampled_from(["strict", "reentry"]))
def test_bounces_equal_sequential_rule(spark, recs, variant):
    recs = [(m, t, e, i) for i, (m, t, e) in enumerate(recs)]
    lines = [log_line(m, t, page="p", last=None if e else "q") for m, t, e, _ in recs]
    raw = topic(spark, lines)
    pages = log_split.page_rows(log_split.parse_log_topic(raw))
    got = sorted(r.seq for r in bounce.bounces(pages, GAP, variant, key_rows=log_split.page_keys(raw)).collect())
    assert got == _brute_bounces(recs, variant)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_strategy)
def test_repair_and_unique_visitor_equal_sequential_rule(spark, recs):
    recs = [(m, t * 3_600_000, i) for i, (m, t, _) in enumerate(recs)]  # hours: spans days
    raw = topic(spark, [log_line(m, t, page="p") for m, t, _ in recs])
    log = log_split.parse_log_topic(raw)
    fixed = visitors.repair_new_visitor(log, log_split.log_keys(raw))
    got_new = sorted(r.seq for r in fixed.collect() if r.common["is_new"].toPython() == "1")
    df = pd.DataFrame(recs, columns=["mid", "ts", "seq"]).sort_values(["ts", "seq"])
    assert got_new == sorted(df.groupby("mid").head(1)["seq"])
    df["day"] = df["ts"] // 86_400_000
    got_uv = sorted(r.seq for r in visitors.unique_visitors(log_split.page_rows(log)).collect())
    assert got_uv == sorted(df.groupby(["mid", "day"]).head(1)["seq"])


maps_strategy = st.one_of(
    st.none(),
    st.dictionaries(st.sampled_from(["a", "b", "c", "ts", "mid"]), st.text(max_size=3), max_size=4),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(maps_strategy, min_size=1, max_size=4))
def test_overlay_equals_dict_merge(spark, maps):
    from pyspark.sql import functions as F

    from shoplake.functions.maps import overlay

    cols = [f"m{i}" for i in range(len(maps))]
    schema = ", ".join(f"{c} map<string,string>" for c in cols)
    df = spark.createDataFrame([tuple(maps)], schema)
    got = df.select(overlay(*cols, values="string").alias("o")).first()["o"]
    want = {}
    for m in maps:
        want.update(m or {})
    assert dict(got) == want
