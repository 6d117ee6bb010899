"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are compared once per distinct value. The 64 bits are grouped
into partitions of correlated bits (counted over all fingerprints). A pair
within ``MAX_BITS`` differing bits must, for thresholds with
``sum(t_i + 1) = MAX_BITS + 1``, differ in at most ``t_i`` bits of some
partition; ``t_i = -1`` leaves a partition out. Dynamic programming picks the
partition count and the thresholds with the least estimated cost, from bit
frequencies of all fingerprints: rows to probe with plus candidate pairs.

A fingerprint is filed under its own bits of a partition and probes with
every value up to ``t_i`` flipped bits away. Rows meet by (partition, value);
each meeting verifies all its candidates on all 64 bits and passes on a
spanning forest of the verified links, never all pairs. Meetings of more than
``CROWD`` rows are dealt into pairs of slices, each a task's share.

Null and edge cases: a null text is empty; texts without words have
fingerprint zero and link like any other; fewer words than a shingle are one
shingle; a null ``doc_id`` never names a component (its name is null when no
member has an id); repeated rows are separate rows of one fingerprint; other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import written
from shoplake.llm.components import connected

SHINGLE = 4
MAX_BITS = 4
SEED = 42
CROWD = 4096
SLAB = 1 << 16
ROW_COST, PAIR_COST = 1.0, 0.02
PARTITIONS = (2, 3, 4, 5)


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles, unsigned."""
    words = raw.lower().split()  # ASCII lower case, ASCII white space
    if not words:
        return 0
    body = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    first = [0, *(ends[: n - 1] + 1).tolist()]
    last = ends[shingle - 1 :].tolist() if len(words) >= shingle else [len(body)]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for a in range(0, n, SLAB):
        h = np.array([digest(body[s:e], SEED) for s, e in zip(first[a : a + SLAB], last[a : a + SLAB])], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * total > n).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """All columns but ``text``, and ``fp`` (the fingerprint's 64 bits as a signed long)."""
    rest = [c for c in docs.columns if c.lower() not in (text.lower(), "fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = len(rest)
            fps = np.array([fingerprint((t.as_py() or "").encode(), shingle) for t in b.column(at)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(j) for j in range(at)), pa.array(fps.view(np.int64), pa.int64())], names=[*rest, "fp"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest), "fp long"])
    return docs.select(*rest, text).mapInArrow(run, schema)


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and how often each pair of bits is set together (64 x 64), over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64)), 0
        for b in batches:
            x = _bits(b.column(0).to_numpy()).astype(np.float32)
            both += (x.T @ x).astype(np.float64)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097), pa.int32()), pa.array(np.append(both.ravel(), n).astype(np.int64), pa.int64())], names=["i", "n"])

    rows = fps.select("fp").mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()  # 4097 rows
    out = np.zeros(4097)
    for r in rows:
        out[r.i] = r.n
    return int(out[-1]), out[:-1].reshape(64, 64)


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, strongly correlated bits together."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    cor = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(cor, 0)
    free, groups = list(range(64)), []
    for k in range(parts):
        room = len(free) // (parts - k)
        sub = cor[np.ix_(free, free)]
        group = [free[int(np.argmax(sub.sum(axis=1)))]]
        while len(group) < room:
            rest = [b for b in free if b not in group]
            group.append(rest[int(np.argmax(cor[np.ix_(rest, group)].mean(axis=1)))])
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


def estimate(n: int, both: np.ndarray, group: list[int], t: int) -> float:
    """Cost of threshold ``t`` on a partition: rows to move and candidate pairs, from bit frequencies."""
    if t < 0:
        return 0.0
    p = np.diag(both)[group] / max(n, 1)
    near = np.zeros(t + 1)
    near[0] = 1.0
    for d in 2 * p * (1 - p):  # chance that two fingerprints differ in the bit
        near[1:] = near[1:] * (1 - d) + near[:-1] * d
        near[0] *= 1 - d
    return n * len(flips(group, t)) * ROW_COST + n * n / 2 * near.sum() * PAIR_COST


def flips(group: list[int], t: int) -> list[int]:
    """Masks of up to ``t`` bits of the group, as signed longs."""
    masks = [sum(1 << b for b in c) for k in range(t + 1) for c in combinations(group, k)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def allocate(n: int, both: np.ndarray, max_bits: int, counts=PARTITIONS) -> list[tuple[list[int], int]]:
    """The partitions and thresholds of least estimated cost; partitions left out are not listed."""
    best, choice = float("inf"), []
    for parts in counts:
        groups = correlated_groups(n, both, parts)
        need = max_bits + 1  # sum of t + 1
        table = {0: (0.0, [])}
        for g in groups:
            new: dict[int, tuple[float, list]] = {}
            for have, (cost, picked) in table.items():
                for t in range(-1, min(2, len(g) - 1) + 1):
                    at = have + t + 1
                    c = cost + estimate(n, both, g, t)
                    if at <= need and c < new.get(at, (float("inf"),))[0]:
                        new[at] = (c, [*picked, (g, t)])
            table = new
        if need in table and table[need][0] < best:
            best, choice = table[need]
    if not choice:
        raise ValueError(f"no partition of 64 bits finds {max_bits} differing bits")
    return [(g, t) for g, t in choice if t >= 0]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per connected component of the links."""
    nodes, inv = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[away], nodes[label[away]]


def _near(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(x, y)) <= max_bits


def _meet(max_bits: int):
    """Verifies candidates of each meeting; rows arrive sorted by meeting, meetings may span batches."""

    def links_of(meeting: np.ndarray, fp: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        got, held = [], 0
        i = np.arange(len(fp))
        for d in range(1, len(fp)):
            i = i[: np.searchsorted(i, len(fp) - d)]
            i = i[meeting[i] == meeting[i + d]]  # equal to a row d on: so to all between
            if not len(i):
                break
            ok = i[~(probe[i] & probe[i + d]) & _near(fp[i], fp[i + d], max_bits)]
            ok = ok[fp[ok] != fp[ok + d]]
            got.append((fp[ok].view(np.int64), fp[ok + d].view(np.int64)))
            held += len(ok)
            if held > 1 << 20:
                got = [_forest(*(np.concatenate(x) for x in zip(*got)))]
                held = len(got[0][0])
        if not held:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return _forest(*(np.concatenate(x) for x in zip(*got)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            cols = [b.column(j).to_numpy(zero_copy_only=False) for j in range(5)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            new = np.append(True, (np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0))
            cut = int(np.flatnonzero(new)[-1])  # the last meeting may go on
            rest = [c[cut:] for c in cols]
            if cut:
                yield table(new[:cut], *(c[:cut] for c in cols))
        if rest is not None and len(rest[0]):
            new = np.append(True, np.zeros(len(rest[0]) - 1, dtype=bool))
            yield table(new, *rest)

    def table(new, part, key, pair, fp, probe):
        a, b = links_of(np.cumsum(new), fp.view(np.uint64), probe.astype(bool))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD, counts=PARTITIONS) -> DataFrame:
    """Links ``a, b`` whose components are those of all fingerprint pairs within ``max_bits`` (distinct ``fp``, written)."""
    n, both = bit_statistics(fps)
    empty = fps.sparkSession.createDataFrame([], "a long, b long")
    if n < 2:
        return empty
    rows = None
    for i, (group, t) in enumerate(allocate(n, both, max_bits, counts)):
        own = F.col("fp").bitwiseAND(F.lit(_mask(group)).cast("bigint"))
        r = fps.select(F.lit(i).alias("part"), "fp", own.alias("own"), F.explode(F.lit(flips(group, t)).cast("array<bigint>")).alias("m"))
        r = r.select("part", F.col("own").bitwiseXOR(F.col("m")).alias("key"), "fp", (F.col("m") != 0).alias("probe"))
        rows = r if rows is None else rows.unionByName(r)
    rows = written(rows, "probes")
    size = rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.bool_and("probe").alias("idle")).where("n > 1 and not idle")
    met = rows.join(size.select("part", "key", "n"), ["part", "key"])
    # crowds are cut into g slices by hash; each pair of slices is a meeting of its own
    g = F.ceil(F.col("n") / crowd).cast("int")
    mine = F.pmod(F.xxhash64("fp"), g).cast("int")
    met = met.withColumn("g", g).withColumn("mine", mine)
    other = F.explode(F.when(F.col("g") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("g") - 1)))
    met = met.withColumn("other", other)
    pair = (F.least("mine", "other").cast("bigint") * (1 << 31) + F.greatest("mine", "other")).alias("pair")
    met = met.select("part", "key", pair, "fp", "probe")
    dealt = met.repartition("part", "key", "pair").sortWithinPartitions("part", "key", "pair")
    return dealt.mapInArrow(_meet(max_bits), "a long, b long")


def _mask(group: list[int]) -> int:
    m = sum(1 << b for b in group)
    return m - (1 << 64) if m >= 1 << 63 else m


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, crowd: int = CROWD, counts=PARTITIONS) -> DataFrame:
    """All columns but ``text``, with ``fp``, ``root`` (its component's least fingerprint) and ``component_id``."""
    rest = [c for c in docs.columns if c.lower() not in ("text", "fp", "root", "component_id")]
    marked = written(fingerprints(docs.select(*rest, "text"), shingle), "fingerprints")
    own = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = connected(near_links(own.select("fp"), max_bits, crowd, counts))
    named = own.join(roots, own["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return marked.join(named.join(ids, "root").select("fp", "root", "component_id"), "fp").select(*rest, "fp", "root", "component_id")


def component_digests(docs: DataFrame) -> DataFrame:
    near = near_duplicates(docs.select("doc_id", "text"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
