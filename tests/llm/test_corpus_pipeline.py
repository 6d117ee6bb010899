"""The pipeline stage by stage against plain rules, and the registered queries."""

import random
import re

import corpus_pipeline as P
import pytest

from shoplake.llm.common import written
from shoplake.llm.toxicity import score_toxicity

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, seen = docs.columns, [docs]
    for name, stage in P.STAGES:
        seen.append(written(stage(spark, seen[-1], SF), "test-stage"))
        if name != "packing":
            assert seen[-1].columns == cols
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in seen[:5]]
    text = [{r.doc_id: r.text for r in d.collect()} for d in seen[:5]]
    # toxic documents go, and only they
    bad = {r.doc_id for r in score_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    assert set(ids[1]) == set(ids[0]) - bad
    # one document of each group of equal texts
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    best = {}
    for i, t in text[1].items():
        k = norm(t)
        best[k] = min(best.get(k, (0, 1 << 62)), (-len(t or ""), i))
    assert sorted(ids[2]) == sorted(i for _, i in best.values())
    # one document of each SimHash component: the least id
    from test_llm_operators import components_reference, fp_reference

    keys = sorted(text[2])
    roots = components_reference([fp_reference(text[2][i]) for i in keys], keys)
    assert sorted(ids[3]) == sorted(set(roots))
    # no benchmark phrase is left, other texts are as they were
    from shoplake.llm.decontam import brute_force

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(ids[4]) == sorted(ids[3])
    for i in ids[4]:
        hit = brute_force(text[3][i], items)[1]
        assert text[4][i] == text[3][i] if not hit else brute_force(text[4][i], items)[1] < hit
    assert {r.doc_id for r in seen[5].select("doc_id").distinct().collect()} == set(ids[4])
    assert P.run(spark, SF).count() == seen[5].count()


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES[:4]], ids=[n for n, _ in P.STAGES[:4]])
def test_stage_on_odd_rows(spark, stage):
    rng = random.Random(2)
    body = " ".join(rng.choice("abcdefgh") * 3 for _ in range(50))
    rows = [(None, None, None, None, None), (None, body, "en", None, 3), (1, body + " z", None, "s", None), (1, body + " z", None, "s", None), (2, "", None, None, 0), (None, "other words", None, None, 1), (2, "yet " * 40, "x", "y", 5)]
    docs = spark.createDataFrame([(*r, 9, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, keep_id int, root int")
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns
    got = [r.text for r in out.collect()]
    assert {t for t in got if t} >= {"other words", "yet " * 40} and len(got) >= 4
    assert stage(spark, docs.limit(0), SF).count() == 0
