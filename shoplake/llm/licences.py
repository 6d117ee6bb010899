"""Licence scans with a trained paragraph classifier.

Paragraphs (lines of text, and the joined lines between blank lines in spans of
``SPAN`` words, for wrapped notices) become sparse word n-grams: those of the public
notices below that are rare in the corpus, by counts over all lines that no template confirms. A multinomial logistic regression
tells the licence families and an unknown class apart. It learns from the
notices in many wordings, from sentences that only speak about licences, and
from a bounded sample of the corpus' own unconfirmed lines as unknown
(twice ``BACKGROUND`` distinct ones, first by hash). A paragraph can leave the unknown class
only through an n-gram that speaks for a family more than for unknown, so one
pattern over such n-grams' rarest words finds all paragraphs that must be
scored; the rest need no score to be unknown. The unknown class is
calibrated on all lines: a family counts only above the probability that
``FALSE_RATE`` of the unconfirmed lines would pass. Every prediction
must then be confirmed by a template of its family: ``CONFIRM`` of the
template's word pairs, or of a long paragraph's, are shared; a bare name or SPDX
id confirms a line that holds little else. "MIT" or "ISC" alone is not enough.

All work on documents is DataFrame code (Spark SQL and Spark ML stages).
Paragraphs are scored where they are read and only the few confirmed ones are
shuffled, with one narrow row per document.

Null and edge cases: a null or empty text has no paragraph; blank paragraphs
do not count; repeated rows are separate documents with equal findings; null
ids are kept; extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm.common import bounded_sample, text_or_empty, written

#: Public licence names and notices.
NAMES = {
    "mit": ["mit license", "mit licence", "expat license"],
    "apache-2.0": ["apache license version 2.0", "apache license 2.0", "apache 2.0 license"],
    "gpl": ["gnu general public license version 3", "gnu general public license version 2", "gnu general public license", "gnu gpl v3", "gpl version 3"],
    "lgpl": ["gnu lesser general public license version 3", "gnu lesser general public license", "gnu lgpl v2.1"],
    "agpl": ["gnu affero general public license version 3", "gnu affero general public license", "gnu agpl v3"],
    "bsd": ["bsd license", "bsd 3-clause license", "bsd 2-clause license", "new bsd license"],
    "mpl-2.0": ["mozilla public license version 2.0", "mozilla public license v. 2.0", "mpl 2.0"],
    "isc": ["isc license"],
    "cc-by": ["cc by 4.0", "creative commons attribution 4.0 international license", "cc by 3.0"],
    "cc-by-sa": ["cc by-sa 4.0", "creative commons attribution-sharealike 4.0 international license", "cc by-sa 3.0"],
    "cc-by-nc": ["cc by-nc 4.0", "creative commons attribution-noncommercial 4.0 international license", "cc by-nc 3.0"],
    "public-domain": ["unlicense", "cc0 1.0 universal public domain dedication"],
}
NOTICES = {
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ],
    "apache-2.0": [
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
        "apache license version 2.0 january 2004 http www.apache.org licenses",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    ],
    "gpl": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "agpl": ["you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    ],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "public-domain": ["this is free and unencumbered software released into the public domain"],
}
#: SPDX ids (lower case, as tokens).
IDS = {
    "mit": ["mit"], "apache-2.0": ["apache-2.0"], "gpl": ["gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later", "gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later"],
    "lgpl": ["lgpl-2.1", "lgpl-2.1-only", "lgpl-2.1-or-later", "lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later"], "agpl": ["agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later"],
    "bsd": ["bsd-2-clause", "bsd-3-clause"], "mpl-2.0": ["mpl-2.0"], "isc": ["isc"], "cc-by": ["cc-by-3.0", "cc-by-4.0"], "cc-by-sa": ["cc-by-sa-3.0", "cc-by-sa-4.0"],
    "cc-by-nc": ["cc-by-nc-3.0", "cc-by-nc-4.0"], "public-domain": ["unlicense", "cc0-1.0"],
}
LEADS = ["licensed under the", "licensed under", "released under the", "this work is licensed under the", "this work is licensed under a", "distributed under the terms of the", "available under the", "published under", "this software is covered by the", "use is subject to the"]
ABOUT = [
    "a driver license is needed to rent a car", "see the license file for details", "all rights reserved", "the license expired last year",
    "this work is done under pressure", "released under the cover of night", "licensed under state law to practise medicine",
    "distributed under the door every morning", "the public was not told about the general plan", "version 2 of the plan was published",
    "a commercial licence was sold to the company", "the software is great and free of charge", "creative people like common ground",
]
FAMILIES = ["unknown", *NAMES]
BACKGROUND = 4000
RARE = 0.01
CONFIRM = 0.6
SLACK = 2
SPAN = 64
FALSE_RATE = 0.0005
BLANK = "(?:\\r\\n|\\n|\\r(?!\\n))[ \\t]*(?:\\r\\n|\\n|\\r(?!\\n))\\s*"
TOKENS = "[^\\p{L}\\p{N}.-]+|[.-]+(?![\\p{L}\\p{N}])|(?=[.-])(?<![\\p{L}\\p{N}])[.-]+"  # the lookahead first: it fails at once inside words


def templates() -> list[tuple[str, str]]:
    """Family and text: every notice, and every name in each of its wordings."""
    named = [(f, f"{lead} {name}") for f, names in NAMES.items() for name in names for lead in LEADS]
    return named + [(f, n) for f, notices in NOTICES.items() for n in notices]


def headings() -> list[tuple[str, str]]:
    """Family and text of lines that only name a licence: bare names, SPDX ids and lines that lead to one."""
    named = [(f, form.format(n)) for f, names in NAMES.items() for n in names for form in ("{}", "the {}", "license {}", "licence {}", "license the {}")]
    ids = [(f, form.format(i)) for f, own in IDS.items() for i in own for form in ("license {}", "licence {}", "spdx-license-identifier {}")]
    # "mit" and "isc" alone are ordinary words or names
    alone = [(f, i) for f, own in IDS.items() for i in own if "-" in i]
    return [*named, *ids, *alone, ("mit", "the mit license mit")]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKENS), lambda w: w != "")


def _pairs(words: Column) -> Column:
    return F.array_distinct(F.when(F.size(words) < 2, words).otherwise(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, k, block, pos, paragraph``: the lines of every text that are not blank, numbered in the blocks between blank lines."""
    lines = _blocks(docs).select("doc_id", "k", "block", F.posexplode(F.split("body", "[\\n\\r]+")).alias("pos", "paragraph"))
    return lines.where(F.trim("paragraph") != "")


def wrapped(docs: DataFrame, pattern: str = "") -> DataFrame:
    """As ``paragraphs``, but the lines of a block joined: ``SPAN`` words each, half a span apart, so a wrapped notice falls whole into one.

    Only blocks that match ``pattern`` (a word of theirs) are cut into words; no other block has a span that does.
    """
    blocks = _blocks(docs).where(F.trim("body").rlike("[\\n\\r]") & F.lower("body").rlike(pattern))
    many = blocks.withColumn("w", F.element_at(F.transform(F.array(_words(F.col("body"))), lambda w: w), 1))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - SPAN // 2 - 1, F.lit(0)), F.lit(SPAN // 2))
    return many.select("doc_id", "k", "block", F.explode(F.transform(starts, lambda a: F.array_join(F.slice(F.col("w"), a + 1, SPAN), " "))).alias("paragraph")).select(
        "doc_id", "k", "block", F.lit(-1).alias("pos"), "paragraph"
    )


def _blocks(docs: DataFrame) -> DataFrame:
    body = docs.select("doc_id", text_or_empty().alias("text"))
    return body.select("doc_id", F.xxhash64("text").alias("k"), F.posexplode(F.split("text", BLANK)).alias("block", "body"))


def known_pairs(spark: SparkSession) -> DataFrame:
    """A row per family: the word pairs of its templates (``ts``) and of its headings (``hs``), of fixed number."""
    rows = [(f, t, True) for f, t in templates()] + [(f, t, False) for f, t in headings()]
    one = spark.createDataFrame(rows, "family string, template string, long boolean").select("family", "long", _pairs(_words(F.col("template"))).alias("t"))
    return one.groupBy("family").agg(F.collect_list(F.when(F.col("long"), F.col("t"))).alias("ts"), F.collect_list(F.when(~F.col("long"), F.col("t"))).alias("hs"))


def _once(rows: DataFrame, values: Column) -> DataFrame:
    """Adds the fields of a struct; a filter on them is not pushed below the generator, where it would compute them again at each mention."""
    return rows.select("*", F.inline(F.array(values)))


def with_pairs(rows: DataFrame, where: Column | None = None) -> DataFrame:
    """Adds ``hit``, the paragraph's word pairs that some template holds, and ``n_own``, its number of pairs (null unless ``where``)."""
    pairs = sorted({x for r in known_pairs(rows.sparkSession).collect() for t in [*r.ts, *r.hs] for x in t})  # of the templates
    own = F.element_at(F.transform(F.array(_words(F.col("paragraph"))), _pairs), 1)
    both = F.element_at(F.transform(F.array(own), lambda o: F.struct(F.filter(o, lambda x: x.isin(pairs)).alias("hit"), F.size(o).alias("n_own"))), 1)
    return _once(rows, both if where is None else F.when(where, both))


def similarity(ts: Column, hs: Column) -> Column:
    """The greatest share of a template's pairs, or of a long paragraph's, and of a heading's pairs in a line of little else (``SLACK`` pairs)."""
    shared = lambda t: F.size(F.array_intersect("hit", t)) / F.least(F.size(t), F.greatest(F.col("n_own"), F.lit(3)))
    named = lambda t: F.size(F.array_intersect("hit", t)) / F.greatest(F.size(t), F.col("n_own") - SLACK)
    short = F.when(F.col("n_own") <= 12 + SLACK, F.array_max(F.transform(hs, named)))
    return F.when(F.size("hit") > 0, F.greatest(F.array_max(F.transform(ts, shared)), short, F.lit(0.0))).otherwise(0.0)


def _grams(text: Column) -> Column:
    """Words, word pairs and word triples."""
    def grams(w: Column) -> Column:
        rest = lambda k: F.slice(w, k, F.greatest(F.size(w) - k + 1, F.lit(0)))
        two = F.zip_with(rest(1), rest(2), lambda a, b: F.concat(a, F.lit(" "), b))
        three = F.zip_with(F.zip_with(rest(1), rest(2), lambda a, b: F.concat(a, F.lit(" "), b)), rest(3), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.filter(F.concat(w, two, three), lambda g: g.isNotNull())

    return F.element_at(F.transform(F.array(_words(text)), grams), 1)


@dataclass
class LicenceModel:
    """The fitted stages, the number of unconfirmed lines, and the pattern that every non-unknown paragraph matches."""

    stages: PipelineModel
    lines: int
    pattern: str


def _pattern(keys: list[str]) -> str:
    """A pattern for lower-case text that holds one of the words ``keys``; shared beginnings are written once."""
    tree: dict = {}
    for key in keys:
        at = tree
        for c in key:
            at = at.setdefault(c, {})
        at[""] = {}

    def branch(at: dict) -> str:
        rest = [re.escape(c) + branch(below) for c, below in sorted(at.items()) if c]
        if not rest:
            return ""
        one = rest[0] if len(rest) == 1 and "" not in at else "(?:" + "|".join(rest) + ")"
        return one + ("?" if "" in at else "")

    return f"(?<![\\p{{L}}\\p{{N}}]){branch(tree)}(?![\\p{{L}}\\p{{N}}])" if keys else "(?!)"


def deciding_pairs(known: list[list[str]], share: dict[str, float]) -> list[str]:
    """Of each template the pairs with the rarest words, so many that whoever shares ``CONFIRM`` of its pairs has one of them."""
    out: set[str] = set()
    for t in known:
        least = next(k for k in range(len(t) + 1) if k / len(t) >= CONFIRM)
        out.update(sorted(t, key=lambda x: (min(share.get(w, 0) for w in x.split(" ")), x))[: len(t) - least + 1])
    return sorted(out)


def _confirmed(rows: DataFrame, where: Column | None = None, share: dict[str, float] | None = None) -> DataFrame:
    """Adds ``confirmed``: some template of any family confirms the paragraph (false unless ``where``).

    Only a paragraph that shares ``CONFIRM`` of its own pairs or holds a deciding pair of a template is compared with
    the templates: no other reaches the limit. ``share`` of the words in the corpus makes deciding pairs rare.
    """
    known = known_pairs(rows.sparkSession).collect()  # of the templates, of fixed size: literals, so no row carries them
    ts, hs = (F.from_json(F.lit(json.dumps([t for r in known for t in r[c]])), "array<array<string>>") for c in ("ts", "hs"))
    rare = deciding_pairs([t for r in known for t in [*r.ts, *r.hs]], share or {})
    may = (F.size("hit") / F.greatest(F.col("n_own"), F.lit(3)) >= CONFIRM) | F.exists("hit", lambda x: x.isin(rare))
    return with_pairs(rows, where).withColumn("confirmed", F.when(may, similarity(ts, hs) >= CONFIRM).otherwise(False)).drop("hit", "n_own")


def train(spark: SparkSession, docs: DataFrame, background: int = BACKGROUND) -> LicenceModel:
    every = [(FAMILIES.index(f), t) for f, t in [*templates(), *headings()]]
    known = spark.createDataFrame(every, "label int, paragraph string")
    # confirmed corpus paragraphs are no examples of the unknown class
    pool = written(_confirmed(bounded_sample(paragraphs(docs), 2 * background, "paragraph")).where("not confirmed").select("paragraph"), "licence-background")

    texts = [r.w for r in known.select(_words(F.col("paragraph")).alias("w")).collect()]  # of the templates
    words = sorted({w for t in texts for w in t})
    marks = F.array_distinct(F.filter(F.split(F.lower("paragraph"), TOKENS), lambda w: w.isin(words)))

    def marked(lines: DataFrame) -> DataFrame:
        """Adds the template words of each line; the generator keeps them from being computed again where they are used."""
        return lines.select("paragraph", F.inline(F.array(F.struct(marks.alias("marks")))))

    def seen(lines: DataFrame) -> tuple[dict[str, float], int]:
        """The share of lines that hold each word of the templates, and the number of lines."""
        n = {r.word: r.n for r in lines.select(F.explode(F.concat(F.array(F.lit("")), "marks")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = n.pop("", 0)
        return {w: k / max(1, total) for w, k in n.items()}, total

    # a confirmed line holds a rare word of its template: only such lines are compared with the templates
    guess, _ = seen(marked(pool))
    may = sorted({w for t in texts for w in t if guess.get(w, 0) < RARE} | {min(t, key=lambda w: guess.get(w, 0)) for t in texts})
    often, total = seen(_confirmed(marked(paragraphs(docs)), F.exists("marks", lambda w: w.isin(may)), guess).where("not confirmed"))
    grams = {r.g for r in known.select(F.explode(_grams(F.col("paragraph"))).alias("g")).distinct().collect()}  # of the templates
    key = {g: min(g.split(" "), key=lambda w: (often.get(w, 0), -len(w), w)) for g in grams}
    vocab = sorted(g for g in grams if often.get(key[g], 0) < RARE)

    about = spark.createDataFrame([(t,) for t in ABOUT], "paragraph string")
    unknown = pool.unionByName(about).select(F.lit(0).alias("label"), "paragraph")
    rows = known.unionByName(unknown).select(F.col("label").cast("double").alias("label"), _grams(F.col("paragraph")).alias("grams")).coalesce(4)
    count = CountVectorizerModel.from_vocabulary(vocab, inputCol="grams", outputCol="features")
    count.setBinary(True)
    fitted = LogisticRegression(maxIter=40, regParam=0.002, elasticNetParam=0.3).fit(count.transform(rows))
    stages = PipelineModel([count, fitted])

    lead, weight = fitted.interceptVector.toArray(), fitted.coefficientMatrix.toArray()
    if (lead[1:] >= lead[0]).any():
        raise ValueError("a paragraph without any n-gram must be unknown")
    keys = sorted({key[g] for j, g in enumerate(vocab) if (weight[1:, j] > weight[0, j]).any()})
    return LicenceModel(stages, total, _pattern(keys))


def find_licences(docs: DataFrame, background: int = BACKGROUND) -> DataFrame:
    """``doc_id, k, block, pos, family, probability, similarity, paragraph`` of every confirmed paragraph."""
    spark = docs.sparkSession
    model = train(spark, docs, background)
    likely_docs = docs.where(F.lower("text").rlike(model.pattern))
    may = paragraphs(likely_docs).unionByName(wrapped(likely_docs, model.pattern)).where(F.lower("paragraph").rlike(model.pattern))
    count, logistic = model.stages.stages
    counted = count.transform(_once(may, F.struct(_grams(F.col("paragraph")).alias("grams")))).withColumnRenamed("features", "_f").drop("grams")
    scored = logistic.transform(_once(counted, F.struct(F.col("_f").alias("features"))).drop("_f"))
    scored = _once(scored.select(*may.columns, F.col("prediction").alias("_n"), vector_to_array("probability").alias("_p")), F.struct(F.col("_n").alias("prediction"), F.col("_p").alias("p")))
    family = F.element_at(F.lit(FAMILIES), F.col("prediction").cast("int") + 1)
    likely = scored.where(F.col("prediction") > 0).select(
        "doc_id", "k", "block", "pos", "paragraph", family.alias("family"), F.element_at("p", F.col("prediction").cast("int") + 1).alias("probability")
    ).where(F.col("probability") > 0.5)  # the limit is not below
    alike = with_pairs(likely).join(F.broadcast(known_pairs(spark)), "family").withColumn("similarity", similarity(F.col("ts"), F.col("hs"))).drop("hit", "n_own", "ts", "hs")
    alike = written(_confirmed(alike), "licence-scores")
    # the quantile over all unconfirmed lines: those not scored here are below 0.5
    calm, passed = alike.where("pos >= 0 and not confirmed"), FALSE_RATE * model.lines
    n, limit = calm.count(), 0.5
    if n > passed:
        limit = calm.select(F.percentile_approx("probability", 1 - passed / n, 10_000)).first()[0]
    return alike.where((F.col("similarity") >= CONFIRM) & (F.col("probability") > max(0.5, limit))).drop("confirmed")


def licence_scan(docs: DataFrame, background: int = BACKGROUND) -> DataFrame:
    """One row per document: ``doc_id, n_paragraphs, n_licence, families, best_similarity``."""
    # lines; a wrapped notice counts once where no line of its block has its family
    one = find_licences(docs, background).groupBy("doc_id", "k", "block", "family").agg(
        F.greatest(F.count_distinct(F.when(F.col("pos") >= 0, F.col("pos"))), F.lit(1)).alias("n"), F.max("similarity").alias("similarity")
    )
    found = one.groupBy("doc_id", "k").agg(
        F.sum("n").alias("n_licence"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.max("similarity").alias("best_similarity")
    )
    body = docs.select("doc_id", text_or_empty().alias("text"))
    every = body.select("doc_id", F.xxhash64("text").alias("k"), F.size(F.filter(F.split("text", "[\\n\\r]+"), lambda x: F.trim(x) != "")).cast("bigint").alias("n_paragraphs"))
    f = found.withColumnRenamed("doc_id", "found_id")
    joined = every.join(f, every["doc_id"].eqNullSafe(f["found_id"]) & (every["k"] == f["k"]), "left")
    return joined.select(
        every["doc_id"], "n_paragraphs", F.coalesce("n_licence", F.lit(0)).cast("bigint").alias("n_licence"),
        F.coalesce("families", F.lit("")).alias("families"), F.coalesce("best_similarity", F.lit(0.0)).alias("best_similarity"),
    )
