"""Whole-job cases of the second review."""

import random

import numpy as np
from test_llm_operators import frame

from shoplake.llm import licences, packing
from shoplake.llm.common import bounded_sample

# -- packing --------------------------------------------------------------------------------------


def test_ids_of_the_added_token(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    parts = ["<|endoftext|>", "<|endoftext|", "|>", " ", "\n", "it's", "\u0301", "\u4e2d\u6587", "12", "x"]
    texts = ["x <|endoftext|> y"] + ["".join(rng.choice(parts) for _ in range(12)) for _ in range(300)]
    rows = packing.pack_documents(frame(spark, texts), with_ids=True).collect()
    got = {r.doc_id: np.frombuffer(r.ids, dtype="<u4").tolist() for r in rows}
    assert got == {i: [*tok.encode(t, add_special_tokens=False).ids, packing.END_ID] for i, t in enumerate(texts)}


# -- licences -------------------------------------------------------------------------------------

MARKS = {
    "MIT License": "mit", "The MIT License (MIT)": "mit", "ISC License": "isc", "BSD License": "bsd", "MPL 2.0": "mpl-2.0", "CC BY 4.0": "cc-by",
    "License: MIT": "mit", "# SPDX-License-Identifier: MIT": "mit", "// SPDX-License-Identifier: Apache-2.0": "apache-2.0", "Apache-2.0": "apache-2.0",
    "                                 Apache License\n                           Version 2.0, January 2004": "apache-2.0",
    "Released under the\nMIT License": "mit", "Licensed under the Apache\nLicense, Version 2.0": "apache-2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal": "mit",
    " * Redistribution and use in source and\n * binary forms, with or without modification, are\n * permitted provided that the following conditions\n * are met:": "bsd",
    "The MIT team met the public.": "", "He got his\ndriver license in April.": "", "MIT": "",
}


def filler(rng, n):
    return " ".join(rng.choice("sun sea sky tree bird road house mit the of under and".split()) for _ in range(n))


def test_headings_ids_and_wrapped_notices(spark):
    rng = random.Random(4)
    texts = [f"{filler(rng, 30)}\n\n{m}\n\n{filler(rng, 30)}" for m in MARKS] + [f"{filler(rng, 30)}\n{m}\n{filler(rng, 30)}" for m in MARKS]
    texts += ["\n".join(filler(rng, 12) for _ in range(20)) for _ in range(300)]
    rows = {r.doc_id: r for r in licences.licence_scan(frame(spark, texts)).collect()}
    want = [*MARKS.values(), *MARKS.values()] + [""] * 300
    wrong = [(texts[i], w, rows[i].families) for i, w in enumerate(want) if rows[i].families != w]
    assert not wrong
    assert [rows[i].n_licence for i in range(len(want))] == [int(w != "") for w in want]


def test_licences_where_most_lines_are_licences(spark):
    rng = random.Random(6)
    words = (licences.NOTICES["mit"][0] + " " + licences.NOTICES["mit"][1]).split()
    texts, want = [], []
    for i in range(300):
        w = rng.randint(6, 12)
        body = "\n".join(" ".join(words[a : a + w]) for a in range(0, len(words), w)) if i % 3 else ["Released under the ISC License.", "CC BY 4.0", "License: MIT"][i // 3 % 3]
        texts.append(f"{filler(rng, 20)} {i}\n\n{body}")
        want.append("mit" if i % 3 else ["isc", "cc-by", "mit"][i // 3 % 3])
    got = {r.doc_id: r.families for r in licences.licence_scan(frame(spark, texts)).collect()}
    wrong = [(texts[i], w, got[i]) for i, w in enumerate(want) if got[i] != w]
    assert not wrong


def test_sample_of_many_repeats(spark):
    df = spark.range(200_000).selectExpr("case when id < 199000 then 0 else id end as x")
    assert bounded_sample(df, 100, "x").count() == 100


# -- pipeline -------------------------------------------------------------------------------------


def test_a_row_goes_by_its_own_text(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(8)
    body = lambda bad: " ".join([filler(rng, 40)] + ["blorf snarg"] * bad)
    texts = [body(i % 5 == 0) for i in range(400)]
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    bad, clean = body(True), body(False)
    ids = [*range(400), None, None, 900, 900]
    got = P.drop_toxic(spark, frame(spark, [*texts, bad, clean, bad, clean], ids), str(tmp_path)).collect()
    want = [(i, t) for i, t in zip(ids, [*texts, bad, clean, bad, clean]) if "blorf" not in t]
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(want, key=repr)


def test_prefilter_of_templates_loses_no_confirmed_line(spark):
    """Parts, mixtures and stretched forms of all templates, against the comparison with every template."""
    every = [t.split() for _, t in [*licences.templates(), *licences.headings()]]
    lines = {" ".join(w[a:b]) for w in every for a in range(0, len(w), 3) for b in range(a + 1, len(w) + 1, 2)}
    lines |= {" ".join([*w[: len(w) // 2 + 1], "of", "the", "public", *v[len(v) // 3 :]]) for w, v in zip(every, reversed(every))}
    lines |= {" ".join(x for i, word in enumerate(w) for x in ([word, "word"] if i % 4 == 3 else [word])) for w in every}
    rows = spark.createDataFrame([(x,) for x in sorted(lines)], "paragraph string")
    known = licences.known_pairs(spark).collect()
    share = {"the": 0.5, "of": 0.4, "license": 0.01}

    pairs = {r.paragraph: set(r.own) for r in rows.withColumn("own", licences._pairs(licences._words(rows["paragraph"]))).collect()}

    def confirmed(line: str) -> bool:
        own = pairs[line]
        for r in known:
            for t in r.ts:
                if len(own & set(t)) / min(len(t), max(len(own), 3)) >= licences.CONFIRM:
                    return True
            for h in r.hs:
                if len(own) <= 12 + licences.SLACK and len(own & set(h)) / max(len(h), len(own) - licences.SLACK) >= licences.CONFIRM:
                    return True
        return False

    got = {r.paragraph: r.confirmed for r in licences._confirmed(rows, None, share).collect()}
    assert got == {x: confirmed(x) for x in lines}
    assert 0 < sum(got.values()) < len(got)
