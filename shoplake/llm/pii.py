"""Personal data by weak supervision: voting labelers, expectation-maximisation, a span classifier.

Base spans (email, ip, card, phone) follow fixed patterns and always stay.
Looser patterns give further candidates (written-out emails, phone numbers
without a plus sign, national and bank account numbers). Four labelers vote
+1, 0 or -1 on every candidate: its strict form, its checksum or value
ranges, a gazetteer of endings, prefixes and codes, and the words before it.
Votes are counted over all documents into a table of vote patterns (at most
kinds x 81 x 3 rows, whatever the input). On that table expectation-
maximisation estimates each labeler's reliability per kind, and a logistic
regression on kind, votes and length learns the posteriors. Candidates it
gives ``ACCEPT`` or more are added unless they touch a base span.

Everything on the documents is a Spark SQL expression. A document's row
carries its spans as arrays, so nothing is shuffled but the pattern counts.
Patterns use possessive repeats: they run in linear time and without deep
recursion on long texts, and find what the greedy forms find.

Null and edge cases: a null text is empty and has no spans; ``doc_id`` may be
null or repeat; extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import text_or_empty, written

_LOCAL = "[A-Za-z0-9._%+-]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: kind -> pattern, a literal without which no match can be
BASE = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
#: further candidates: kind -> the kind they are added as, pattern, literal
LOOSE = {
    "email_words": ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[](?:at|AT)[)\]] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[](?:dot|DOT)[)\]]) ?[A-Za-z0-9-]++)++", "[aA][tT]"),
    "phone_plain": ("phone", r"(?<![0-9A-Za-z+().-])(?<![0-9+)] )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])", None),
    "national_id": ("national_id", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "-"),
    "account": ("account", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", None),
}
KINDS = [*BASE, *LOOSE]
#: fixed values: common endings, calling codes, card prefixes
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|it|nl|uk|eu|ch|at|us|ca|jp|cn)$",
    "ip": r"^(?:10\.|127\.|169\.254\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|192\.168\.|1?[0-9]{1,2}\.|2[01][0-9]\.|22[0-3]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+ ?(?:1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "email_words": r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|it|nl|uk|eu|ch|at|us|ca|jp|cn)$",
    "phone_plain": r"^\(?[2-9]",
    "national_id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "account": r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)",
}
CONTEXT = {
    "email": r"(?i)(?:e-?mail|contact|write|from|to|reply|courriel|correo)\W*$",
    "ip": r"(?i)(?:\bip\b|address|host|server|login|adresse)\W*$",
    "card": r"(?i)(?:card|visa|mastercard|credit|payment|karte|carte|tarjeta)\W*(?:no\.?|number|nr\.?)?\W*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|cell|fax|telefon|whatsapp)\w*\W*$",
    "email_words": r"(?i)(?:e-?mail|contact|write|reply|courriel|correo)\W*(?:me|us)?\W*$",
    "phone_plain": r"(?i)(?:phone|tel|call|mobile|cell|fax|telefon|whatsapp)\w*\W*$",
    "national_id": r"(?i)(?:ssn|social|security|insurance|national)\W*(?:no\.?|number|nr\.?|id)?\W*$",
    "account": r"(?i)(?:iban|account|konto|compte|cuenta)\W*(?:no\.?|number|nr\.?)?\W*$",
}
AGAINST = r"(?i)(?:version|release|isbn|issn|order|invoice|ticket|serial|part|section|figure|page|sku)\W*(?:no\.?|number|nr\.?)?\W*$"
BEFORE = 32
ACCEPT = 0.7
ROUNDS = 60
LABELERS = 4
STRIDE = 128


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans_of(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, hit, lead>>`` of the leftmost non-overlapping matches, in code points.

    ``lead`` is what stands before a match, back to the last one or ``BEFORE`` characters.
    Matches and the gaps between them come from the same pattern; sums of
    their lengths, kept per ``STRIDE`` matches, give the places.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("hit"), F.length(g).alias("gap"), F.right(g, F.lit(BEFORE)).alias("lead"), (F.length(g) + F.length(h)).alias("n")))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda acc, x: acc + x)
    span_sum = lambda ps, at, n: F.aggregate(F.slice(ps, at, n), F.lit(0), lambda acc, x: acc + x["n"])
    block = lambda i: F.floor(i / STRIDE).cast("int")

    def place(ps: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), block(F.size(ps))), lambda j: span_sum(ps, j * STRIDE + 1, F.lit(STRIDE)))
        before = _bind(sums, lambda ss: F.transform(ss, lambda _, j: total(F.slice(ss, F.lit(1), j))))

        def one(bs: Column) -> Column:
            def span(x: Column, i: Column) -> Column:
                start = F.get(bs, block(i)) + span_sum(ps, block(i) * STRIDE + 1, i % STRIDE) + x["gap"]
                return F.struct(start.alias("start"), (start + F.length(x["hit"])).alias("end"), x["hit"].alias("hit"), x["lead"].alias("lead"))

            return F.transform(ps, span)

        return _bind(before, one)

    return _bind(pairs, place)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    figures = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(figures, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        "card": lambda: F.when(n.between(14, 19), luhn(_digits(hit))).otherwise(False),
        "phone": lambda: n.between(10, 15),
        "email_words": lambda: F.length(hit) <= 120,
        "phone_plain": lambda: n == 10,
        "national_id": lambda: n == 9,
        "account": lambda: F.length(F.replace(hit, F.lit(" "), F.lit(""))).between(15, 34),
    }[kind]()


def strict(kind: str, hit: Column) -> Column:
    """The form labeler."""
    return {
        "email": lambda: hit.rlike(r"^[A-Za-z0-9][^@]*@(?!-)") & (F.length(hit) <= 100),
        "ip": lambda: ~hit.rlike(r"(?:^|\.)0[0-9]"),
        "card": lambda: ~hit.rlike(r"[\x20-]") | hit.rlike(r"^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1"),
        "phone": lambda: ~hit.rlike(r"[\x20().-]{3}|\)[0-9]"),
        "email_words": lambda: hit.rlike(r"(?i)[a-z]"),
        "phone_plain": lambda: hit.rlike(r"^(?:\([0-9]{3}\) |[0-9]{3}([ .-])[0-9]{3}\1)"),
        "national_id": lambda: F.lit(True),
        "account": lambda: hit.rlike("[0-9]{6}"),
    }[kind]()


def _vote(good: Column, bad: Column | None = None) -> Column:
    no = F.lit(-1) if bad is None else F.when(bad, -1).otherwise(0)
    return F.when(good, 1).otherwise(no)


def pattern_code(kind: str, span: Column) -> Column:
    """Kind, votes (+1 each) and length class of a candidate as one number."""
    hit = span["hit"]
    lead = span["lead"]
    votes = [
        _vote(strict(kind, hit)),
        _vote(valid(kind, hit)),
        _vote(hit.rlike(GAZETTEER[kind])),
        _vote(lead.rlike(CONTEXT[kind]), lead.rlike(AGAINST)),
    ]
    code = F.lit(KINDS.index(kind))
    for v in votes:
        code = code * 3 + v + 1
    length = F.length(hit)
    return code * 3 + F.when(length < 14, 0).when(length < 20, 1).otherwise(2)


def decode(code: int) -> tuple[int, list[int], int]:
    code, size = divmod(code, 3)
    votes = []
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        votes.insert(0, v - 1)
    return code, votes, size


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, base, loose``: arrays of ``start, end, kind, code``; base holds only valid spans."""
    body = docs.select("doc_id", text_or_empty().alias("text"))
    kind_of = "array<struct<start:int,end:int,kind:string,rank:int,code:int>>"
    none = F.array().cast(kind_of)

    def found(kind: str, added_as: str, pattern: str, literal: str | None, base: bool) -> Column:
        text = F.col("text")
        may = F.col("has_digit") if literal is None else F.contains(text, F.lit(literal)) if literal != "[aA][tT]" else text.rlike("(?i)[(\\[]at[)\\]]")
        if literal in ("+", ".", "-"):
            may = may & F.col("has_digit")
        hits = spans_of(text, pattern)
        if base:
            hits = F.filter(hits, lambda s: valid(kind, s["hit"]))
        rank = F.lit(KINDS.index(kind))
        rows = F.transform(hits, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(added_as).alias("kind"), rank.alias("rank"), pattern_code(kind, s).alias("code")))
        return F.when(may, rows.cast(kind_of)).otherwise(none)

    marked = body.withColumn("has_digit", F.col("text").rlike("[0-9]"))
    base = [found(k, k, p, lit, True) for k, (p, lit) in BASE.items()]
    loose = [found(k, a, p, lit, False) for k, (a, p, lit) in LOOSE.items()]
    return marked.select("doc_id", F.concat(*base).alias("base"), F.concat(*loose).alias("loose"))


def reliabilities(counts: dict[int, int], rounds: int = ROUNDS) -> dict[int, float]:
    """Posterior of each vote pattern by expectation-maximisation, per kind, from pattern counts."""
    out = {}
    for kind in range(len(KINDS)):
        rows = [(c, decode(c)[1], n) for c, n in counts.items() if decode(c)[0] == kind]
        share, good = 0.5, [0.8] * LABELERS
        for _ in range(rounds):
            post = []
            for _, votes, _ in rows:
                a, b = math.log(share), math.log(1 - share)
                for v, g in zip(votes, good):
                    if v:
                        a, b = a + math.log(g if v > 0 else 1 - g), b + math.log(1 - g if v > 0 else g)
                post.append(1 / (1 + math.exp(min(700, b - a))))
            total = sum(n for *_, n in rows)
            if not total:
                break
            share = min(0.99, max(0.01, sum(p * n for p, (*_, n) in zip(post, rows)) / total))
            for j in range(LABELERS):
                right = sum(n * (p if v[j] > 0 else 1 - p) for p, (_, v, n) in zip(post, rows) if v[j])
                voted = sum(n for _, v, n in rows if v[j])
                good[j] = min(0.99, max(0.51, (right + 0.8) / (voted + 1)))  # better than chance, by assumption
        out.update({c: p for (c, *_), p in zip(rows, post)} if rows else {})
    return out


def _features(code: int) -> list[float]:
    kind, votes, size = decode(code)
    return [1.0, *(float(kind == k) for k in range(len(KINDS))), *(float(v) for v in votes), float(size == 0), float(size == 2)]


def train_classifier(counts: dict[int, int], posterior: dict[int, float], steps: int = 400, ridge: float = 1e-3) -> list[float]:
    """Logistic regression on the posteriors, by gradient steps over the pattern table."""
    rows = [(_features(c), posterior[c], math.log1p(n)) for c, n in counts.items()]
    total = sum(w for *_, w in rows) or 1.0
    weights = [0.0] * len(_features(0))
    for _ in range(steps):
        grad = [ridge * w for w in weights]
        for x, y, w in rows:
            g = w / total * (probability(weights, x) - y)
            for j, v in enumerate(x):
                if v:
                    grad[j] += g * v
        weights = [a - 2.0 * g for a, g in zip(weights, grad)]
    return weights


def probability(weights: list[float], x: list[float]) -> float:
    z = sum(a * b for a, b in zip(weights, x))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def find_pii(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``doc_id, base, added``: arrays of ``start, end, kind, rank, code`` in order of start."""
    own = written(candidates(docs), "pii-candidates")
    rows = own.select(F.explode(F.concat("base", "loose")).alias("c")).groupBy(F.col("c.code").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    counts = {r.code: r.n for r in rows.collect()}  # a row per vote pattern
    weights = train_classifier(counts, reliabilities(counts))
    good = [c for c in counts if probability(weights, _features(c)) >= accept]
    accepted = F.array(*[F.lit(c) for c in sorted(good)]).cast("array<int>")
    apart = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    added = F.filter("loose", lambda c: F.array_contains(accepted, c["code"]) & apart(c))
    return own.select("doc_id", F.array_sort(own["base"], _by_start).alias("base"), F.array_sort(added, _by_start).alias("added"))


def _by_start(a: Column, b: Column) -> Column:
    x, y = (F.struct(c["start"], c["rank"], c["end"]) for c in (a, b))
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def pii_digests(docs: DataFrame) -> DataFrame:
    found = find_pii(docs)
    write = lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string"))
    count = lambda kind: F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(k) for k in BASE),
        F.sha2(F.array_join(F.transform("base", write), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(F.array_sort(F.concat("base", "added"), _by_start), write), ",").alias("spans"),
    )
