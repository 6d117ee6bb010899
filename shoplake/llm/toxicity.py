"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

A bounded sample of labelled rows gives the examples: at most ``EXAMPLES`` rows
and ``EXAMPLE_BYTES`` bytes of text, the first by hash; a labelled text longer
than a 64th of that is scored but is no example. All words of the examples are
terms. Their document frequencies come from the whole text of all documents. A
term's factor is its inverse document frequency times ``REST`` plus the
logarithm of how far its share of toxic examples is surely (Wilson bound) above
the usual share, so common words count little and none is left out. Words are
told apart by 64-bit hashes. Examples with equal vectors are one entry with its
label counts.

The index holds a posting list per term, cut at blocks of entries, with the
greatest weight of each list in each block. Lists that hold a sixteenth of the
entries or more are kept dense, and their part of all products comes first. A
document's bound for a block is the greatest of these plus the block's greatest
weights times its own; blocks are opened in order of their bounds until no
bound reaches the k-th best product, so the neighbours are exactly those of a
full scan (cosines are rounded to 9 places, ties go to the smaller id). Their votes, weighted
by distance, are smoothed by the usual share and mapped to a probability by
isotonic regression on leave-one-out votes of the examples.

Null and edge cases: null and empty texts, and texts without a term, get the
share of toxic examples among those without a word; rows without ``doc_id``
or label never train; several labels of one document count as toxic if one
is; of several texts under one id the least is the example; repeated rows score
alike; extra columns are ignored. Without labels every score is 0. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import bounded_sample, text_or_empty, written
from shoplake.llm.decontam import CHUNK_BYTES, words_of_bytes

EXAMPLES = 5_000
EXAMPLE_BYTES = 16 << 20
REST = 0.1
NEIGHBOURS = 25
BLOCK = 64
REJECT = 0.7
Z = 2.58
SPARSE = 16
SLACK = 2e-9  # room for rounding in a bound


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, bound: int = EXAMPLES) -> DataFrame:
    """At most ``bound`` labelled ids, the first by hash; held-out ids are never among them."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    one = own.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return written(one.join(bounded_sample(own, bound, "doc_id"), "doc_id", "left_semi"), "toxic-labels")


def word_counts(raw: list[bytes], vocabulary: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each text: where each text's begin, word hashes, counts.

    With a sorted ``vocabulary`` of hashes, its positions stand for the hashes and other words are left out.
    """
    _, start, _, got = words_of_bytes(b"\0".join(raw))
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in raw]), start, side="right")
    word = got.view(np.int64)
    if vocabulary is not None:
        at = np.searchsorted(vocabulary, word)
        known = np.append(vocabulary, 0)[at] == word
        known &= at < len(vocabulary)
        word, doc = at[known], doc[known]
    order = np.lexsort((word, doc))
    word, doc = word[order], doc[order]
    first = np.flatnonzero(np.diff(word, prepend=0).astype(bool) | np.diff(doc, prepend=-1).astype(bool))
    return np.searchsorted(doc[first], np.arange(len(raw) + 1)), word[first], np.diff(first, append=len(word))


def in_chunks(texts: Iterable[pa.Scalar]) -> Iterator[list[bytes]]:
    raw, size = [], 0
    for t in texts:
        raw.append((t.as_py() or "").encode())
        size += len(raw[-1])
        if size > CHUNK_BYTES:
            yield raw
            raw, size = [], 0
    if raw:
        yield raw


def example_vectors(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, example_bytes: int = EXAMPLE_BYTES) -> DataFrame:
    """``doc_id, words, counts, toxic, n``: the distinct word counts of the labelled sample, with the least id and the label counts (written)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, counts = [], []
            for raw in in_chunks(b.column(2)):
                ptr, w, c = word_counts(raw)
                words += np.split(w, ptr[1:-1])
                counts += np.split(c, ptr[1:-1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "toxic", "words", "counts"])

    sample = training_labels(labels, examples).select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(sample), "doc_id")  # at most EXAMPLES rows
    texts = written(rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")), "toxic-texts")
    size = F.octet_length("text")
    sizes = texts.where(size <= example_bytes // 64).select("doc_id", size.alias("size"), F.xxhash64(F.lit(17), "doc_id").alias("h"))
    fit = sizes.withColumn("sum", F.sum("size").over(Window.orderBy("h", "doc_id"))).where(F.col("sum") <= example_bytes).select("doc_id")  # numbers of at most EXAMPLES rows
    some = texts.join(F.broadcast(fit), "doc_id", "left_semi").select("doc_id", "toxic", "text")
    vectors = some.mapInArrow(run, "doc_id long, toxic int, words array<long>, counts array<int>")
    one = vectors.groupBy("words", "counts").agg(F.min("doc_id").alias("doc_id"), F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
    return written(one.select("doc_id", "words", "counts", "toxic", "n").repartition(max(1, examples // 400), "doc_id"), "toxic-examples")


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of documents, and of those that hold each word."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)  # words of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(len(known.value), dtype=np.int64)
        for b in batches:
            n += b.num_rows
            for raw in in_chunks(b.column(0)):
                df += np.bincount(word_counts(raw, known.value)[1], minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(df[some], n), pa.int64())], names=["word", "n"])

    got = docs.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()  # a row per word of the sample
    word, n = got.column("word").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(len(vocabulary), dtype=np.int64)
    out[word[word >= 0]] = n[word >= 0]
    return int(n[word < 0].sum()), out


def term_factors(total: int, df: np.ndarray, n: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Inverse document frequency times ``REST`` plus the sure lift of the toxic share (``n`` examples hold the word, ``toxic`` of them toxic)."""
    p = toxic / n
    low = (p + Z * Z / (2 * n) - Z * np.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)
    lift = np.log(np.maximum(low / share, 1)) if share else 0
    return (np.log((total + 1) / (df + 1)) + 1) * (REST + lift)


def unit(ptr: np.ndarray, counts: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Weights ``(1 + log count) * factor``, each text's of length 1."""
    w = (1 + np.log(counts)) * factor
    square = np.diff(np.append(0, np.cumsum(w * w))[ptr])
    return w / np.sqrt(np.repeat(np.maximum(square, 1e-300), np.diff(ptr)))


def spread(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    end = np.cumsum(length)
    return np.repeat(first - end + length, length) + np.arange(end[-1] if len(end) else 0)


class BlockMaxIndex:
    """Posting lists of vectors that each have a term, with the greatest weight of each list in each block of entries.

    A list that holds more than a ``1 / SPARSE`` of the entries is kept dense, a row of ``common``.
    """

    def __init__(self, ptr: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int, block: int = BLOCK):
        self.parts = ptr, term.astype(np.int32), weight, n_terms, block
        n, row = len(ptr) - 1, np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
        strongest = term[np.lexsort((-weight, row))[ptr[:-1]]]
        self.entry = np.lexsort((np.arange(n), strongest))  # entries with the same strongest term are neighbours
        place = np.empty(n, dtype=np.int64)
        place[self.entry] = np.arange(n)
        at = place[row]
        often = np.bincount(term, minlength=n_terms) * SPARSE > n
        self.dense = np.where(often, np.cumsum(often) - 1, -1)  # row of a dense list
        self.common = np.zeros((int(often.sum()), n))
        mine = often[term]
        self.common[self.dense[term[mine]], at[mine]] = weight[mine]
        term, at, weight = term[~mine], at[~mine], weight[~mine]
        order = np.lexsort((at, term))
        term, self.place, self.weight = term[order], at[order], weight[order]
        self.starts = np.arange(0, n, block)
        cell = term.astype(np.int64) * len(self.starts) + self.place // block
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.cell_first = np.append(first, len(term))
        self.cell_block = self.place[first] // block
        self.cell_max = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        self.list_first = np.searchsorted(term[first], np.arange(n_terms + 1))

    def __reduce__(self):
        return BlockMaxIndex, self.parts  # tasks get the vectors and build the lists

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query (terms, weights) the ``k`` greatest positive products (all, if fewer) and their entries, ties by entry."""
        for a in range(0, len(queries), 256):
            part = queries[a : a + 256]
            q = np.zeros((len(part), len(self.common)))
            for i, (term, weight) in enumerate(part):
                d = self.dense[term]
                q[i, d[d >= 0]] = weight[d >= 0]
            for (term, weight), sims in zip(part, q @ self.common):
                some = self.dense[term] < 0
                yield self._rest(term[some], weight[some], sims, k)

    def _rest(self, term: np.ndarray, weight: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The search of one query, whose products over the dense lists are ``sims``."""
        length = self.list_first[term + 1] - self.list_first[term]
        cells, w = spread(self.list_first[term], length), np.repeat(weight, length)
        block = self.cell_block[cells]
        rest = np.bincount(block, w * self.cell_max[cells], len(self.starts))
        bound = np.maximum.reduceat(sims, self.starts) + rest
        first = np.argsort(-bound, kind="stable")
        first = first[rest[first] > 0]  # the others have their full products
        at, step = 0, 8
        while True:
            least = np.partition(sims, len(sims) - k)[len(sims) - k] if len(sims) > k else 0.0  # products so far are lower bounds
            some = first[at : at + step]
            some = some[bound[some] >= least - SLACK]
            if not len(some):
                break
            opened = np.zeros(len(self.starts), dtype=bool)
            opened[some] = True
            mine = opened[block]
            lo = self.cell_first[cells[mine]]
            length = self.cell_first[cells[mine] + 1] - lo
            post = spread(lo, length)
            sims += np.bincount(self.place[post], np.repeat(w[mine], length) * self.weight[post], len(sims))
            at, step = at + step, step * 8
        best = np.flatnonzero((sims >= least - SLACK) & (sims > SLACK))
        cosine = np.round(sims[best], 9)
        best = self.entry[best]
        order = np.lexsort((best, -cosine))[:k]
        return cosine[order], best[order]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the monotone fit (pool adjacent violators)."""
    o = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for xi, yi, wi in zip(x[o], y[o], w[o]):
        pools.append([xi * wi, yi * wi, wi])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            a = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], a)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


class ToxicityModel:
    """Entries of the index with their label counts; ``knots`` maps a vote to a probability once it is calibrated."""

    def __init__(self, rows: pa.Table, docs: DataFrame, k: int = NEIGHBOURS):
        rows = rows.sort_by("doc_id").combine_chunks()
        toxic, n = (rows.column(c).to_numpy().astype(float) for c in ("toxic", "n"))
        length = np.array([len(x) for x in rows.column("words")], dtype=np.int64)
        some = length > 0
        self.k = k
        self.share = float(toxic.sum() / max(1, n.sum()))
        self.none = float((toxic[~some].sum() + self.share) / (n[~some].sum() + 1))
        self.toxic, self.n, self.ids = toxic[some], n[some], rows.column("doc_id").to_numpy()[some]
        self.index, self.knots = None, None
        if some.any():
            ptr = np.append(0, np.cumsum(length[some]))
            self.vocabulary, word = np.unique(flat(rows.column("words")), return_inverse=True)
            row = np.repeat(np.arange(len(self.n)), length[some])
            held = (np.bincount(word, self.n[row]), np.bincount(word, self.toxic[row]))
            self.factor = term_factors(*document_frequencies(docs, self.vocabulary), *held, self.share)
            self.index = BlockMaxIndex(ptr, word, unit(ptr, flat(rows.column("counts")), self.factor[word]), len(self.vocabulary))

    def vote(self, sims: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> float:
        w = 1 / (1.05 - np.minimum(sims, 1.0))
        return float(((w * toxic).sum() + self.share) / ((w * n).sum() + 1))

    def left_out(self, words: list[np.ndarray], counts: list[np.ndarray], ids: list[int]) -> Iterator[tuple[float, float, float]]:
        """Votes of an entry's neighbours with one of its examples of a label left out: vote, label, examples of it."""
        at = [np.searchsorted(self.vocabulary, w) for w in words]
        queries = [(t, unit(np.array([0, len(t)]), c, self.factor[t])) for t, c in zip(at, counts)]
        for doc_id, (sims, who) in zip(ids, self.index.search(queries, self.k + 1)):
            me = self.ids[who] == doc_id
            own = int(np.searchsorted(self.ids, doc_id))
            for label, weight in ((1.0, self.toxic[own]), (0.0, self.n[own] - self.toxic[own])):
                if weight:
                    yield self.vote(sims, self.toxic[who] - me * label, self.n[who] - me), label, float(weight)

    def score(self, raw: list[bytes]) -> Iterator[tuple[float, list]]:
        if self.index is None:
            yield from ((self.none, []) for _ in raw)
            return
        ptr, word, counts = word_counts(raw, self.vocabulary)
        w = unit(ptr, counts, self.factor[word])
        keys = [(word[a:b].tobytes(), counts[a:b].tobytes()) for a, b in zip(ptr[:-1], ptr[1:])]
        first = {key: i for i, key in reversed(list(enumerate(keys))) if key[0]}  # equal vectors of this chunk are searched once
        queries = [(word[ptr[i] : ptr[i + 1]], w[ptr[i] : ptr[i + 1]]) for i in first.values()]
        found = {key: self._scored(sims, who) for key, (sims, who) in zip(first, self.index.search(queries, self.k))}
        yield from (found.get(key, (self.none, [])) for key in keys)

    def _scored(self, sims: np.ndarray, who: np.ndarray) -> tuple[float, list]:
        raw = self.vote(sims, self.toxic[who], self.n[who])
        evidence = [{"doc_id": int(self.ids[j]), "cosine": float(c), "toxic_share": float(self.toxic[j] / self.n[j])} for c, j in zip(sims[:3], who[:3])]
        return float(0.99 * np.interp(raw, *self.knots) + 0.01 * raw), evidence


def flat(lists: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in lists.chunks]) if lists.num_chunks else np.zeros(0, dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, example_bytes: int = EXAMPLE_BYTES) -> tuple[ToxicityModel, Broadcast]:
    """The calibrated model, and the model as it was broadcast before (without knots)."""
    vectors = example_vectors(docs, labels, examples, example_bytes)
    model = ToxicityModel(vectors.toArrow(), docs)  # at most EXAMPLES rows of EXAMPLE_BYTES of text
    shared = docs.sparkSession.sparkContext.broadcast(model)
    if model.index is None:
        return model, shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            rows = [(x.values.to_numpy(), c.values.to_numpy(), i) for x, c, i in zip(b.column(1), b.column(2), b.column(0).to_pylist()) if len(x)]
            got = list(m.left_out(*zip(*rows))) if rows else []
            v = list(zip(*got)) if got else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()) for x in v], names=["vote", "label", "n"])

    votes = vectors.select("doc_id", "words", "counts").mapInArrow(run, "vote double, label double, n double").orderBy("vote", "label", "n").toArrow()  # two rows an entry
    model.knots = isotonic(*(votes.column(c).to_numpy() for c in ("vote", "label", "n")))
    return model, shared


def score_toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, example_bytes: int = EXAMPLE_BYTES, keep: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, evidence`` (the nearest examples), and the text column ``keep`` as ``kept``."""
    model, shared = train(docs, labels, examples, example_bytes)
    knots = model.knots
    kept = [] if keep is None else ["kept"]
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic_share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        m.knots = knots
        for b in batches:
            s, evidence = zip(*(x for raw in in_chunks(b.column(1)) for x in m.score(raw))) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array(evidence, kind), *b.columns[2:]], names=["doc_id", "score", "evidence", *kept])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *([] if keep is None else [keep]))
    scored = rows.mapInArrow(run, ", ".join(["doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic_share:double>>", *(f"{c} string" for c in kept)]))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"), "evidence", *kept)
