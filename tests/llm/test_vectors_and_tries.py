"""Whitening, prefix trie and top-k search against plain references, with odd rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from shoplake.llm import metric_tree, prefix_trie, whitening
from shoplake.llm.vectors import usable

VECTORS = "vec_id long, embedding array<float>, label int, x string, n string, node string, part string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", "n", "z", "p") for i, v in rows], VECTORS)


def odd_vectors(size=6, n=300, seed=3):
    """Random rows, repeats, a common vector, ties, and rows that take no part."""
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=size).round(2).tolist()) for i in range(n)]
    rows += [(i, [0.25] * size) for i in range(n, n + n // 2)]  # one vector holds a third
    rows += rows[10:14] + [(50, rng.normal(size=size).tolist())]  # repeated rows; an id with two vectors
    rows += [(None, rows[0][1]), (9000, None), (9001, [None] * size), (9002, [math.nan] * size), (9003, [math.inf] + [0.0] * (size - 1)), (9050, [3e38] * size), (9100, [1.0]), (9150, [])]
    return rows


def as_longs(rows, factor, add, size, limit=2**40):
    """The rows that take part, by the stated rules."""
    out = []
    for i, v in rows:
        if v is None or any(c is None or not math.isfinite(c) or abs(float(np.float32(c)) * factor) >= limit for c in v):
            continue
        x = [math.floor(float(np.float32(c)) * factor) for c in v] + [0] * (size - len(v))
        out.append((i, [c + add for c in x]))
    return out


# -- whitening ------------------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "size"), [(1, 3), (2, 3), (40, 64), (300, 7)])
def test_spectrum_follows_rank_one_updates(n, size):
    x = np.floor(np.random.default_rng(n).normal(size=(n, size)) * 30).astype(np.int64)
    if size == 7:
        x[:, 3], x[:, 4] = x[:, 2], 5  # equal directions and one without variance
    one = whitening.Spectrum.empty(size)
    one.add(x)
    parts = [whitening.Spectrum.empty(size) for _ in range(3)]
    for i, p in enumerate(parts):
        p.add(x[i::3])
    for p in parts[1:]:
        if p.n:
            parts[0].merge(p)
    scatter = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    top = max(1.0, np.linalg.eigvalsh(scatter)[-1])
    for s in (one, parts[0]):
        assert s.n == n and s.sums == x.sum(axis=0).tolist()
        assert np.abs(s.q.T @ s.q - np.eye(size)).max() < 1e-12
        assert np.abs((s.q * s.lam) @ s.q.T - scatter).max() < 1e-12 * top


def test_whitening_equals_a_direct_decomposition(spark):
    rows = odd_vectors()
    got = whitening.whiten(vectors(spark, rows).repartition(5)).toPandas()
    used = as_longs(rows, 64.0, 1_000_000, 6)
    x = np.array([v for _, v in used])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    want = (x - sums / n) @ directions / np.sqrt(values)
    assert len(got) == len(used) * 6 and set(got.n) == {n} and got.identity_error.max() < 1e-10
    assert np.allclose(sorted(set(got.explained.round(14)), reverse=True), (values / values.sum()).round(14))
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums.tolist())) for _, v in used]
    key = lambda i, d, *w: (i is None or math.isnan(i), 0 if i is None or math.isnan(i) else int(i), int(d), *w)
    mine = {}
    for c in range(1, 7):
        part = got[got.component == c]
        mine[c] = sorted(key(i, d, round(abs(w), 7)) for i, d, w in zip(part.vec_id, part.deviation, part.whitened))
        assert mine[c] == sorted(key(i, d, round(abs(w), 7)) for (i, _), d, w in zip(used, deviation, want[:, c - 1]))


def test_whitening_edges(spark):
    empty = whitening.whiten(vectors(spark, []))
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and not empty.collect()
    assert not whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()  # no variance
    flat = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()  # variance in one direction
    assert [(r.vec_id, r.component, round(abs(r.whitened), 9), r.explained) for r in sorted(flat, key=lambda r: r.vec_id)] == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
    assert whitening.Centre(3, [4]).deviation(np.array([[1_000_000 + (1 << 31)]])) == [(3 * (1 << 31) - 4) ** 2 if (3 * (1 << 31) - 4) ** 2 < 1 << 63 else None]
    assert whitening.Centre(1 << 30, [0]).deviation(np.array([[1_000_000 + (1 << 20)]])) == [None]


# -- prefix trie ----------------------------------------------------------------------------------


def trie_reference(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            digest = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
            convs.setdefault(c, []).append((t is not None, t or 0, r, digest, x))
    turns = {c: [(a[2], a[4]) for a in sorted(v)] for c, v in convs.items()}
    nodes, kids, out = {}, {}, {}
    for c, s in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        s = turns.get(c - int(math.fmod(c, 20)), [])[:h] + s[h:]
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append((c, len(s) == d))
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    words = re.compile(r"[^\x20\x09-\x0D]+")
    for p in sorted(nodes, key=len, reverse=True):
        m, under = nodes[p], kids.get(p, [])
        saved = (len(m) - 1) * (len(words.findall(p[-1][1])) if p else 0) + sum(out[k][6] for k in under)
        ends = ",".join(str(c) for c in sorted(c for c, e in m if e))
        up = min(c for c, _ in nodes[p[:-1]]) if p else None
        out[p] = (min(c for c, _ in m), len(p), up, len(m), len(under), sum(out[k][5] for k in under) or 1, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "p", "k", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, keys string, words int")


def odd_conversations():
    rng = random.Random(4)
    says = ["a b c", "a b", "", None, "x \n y\tz", "é é", "w " * 5000]
    rows = []
    for c in [*range(-25, 140), 10**17, 10**17 + 3]:
        if c % 20 or c in (20, 40, 60, 10**17):  # some families lack their head
            rows += [(c, t, rng.choice(["user", "bot", None]), rng.choice(says)) for t in range(rng.choice([1, 1, 2, 3, 5, 9]))]
    rows += [(c, t, "user", "a b c") for c in range(200, 300) for t in range(4)]  # one conversation, many times
    rows += [(300, None, "user", "first"), (300, None, None, "second"), (300, 1, "user", "a"), (300, 1, "user", "a"), (None, 1, "user", "a")]
    rows += [(301, t, "user", f"turn {t % 7}") for t in range(3000)]  # a long one
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [200_000, 40])
def test_prefix_trie_equals_brute_force(spark, shard):
    rows = odd_conversations()
    got = prefix_trie.prefix_trie(conversations(spark, rows), shard_turns=shard).collect()
    assert sorted((tuple(r) for r in got), key=str) == trie_reference(rows)


def test_prefix_trie_edges(spark):
    empty = prefix_trie.prefix_trie(conversations(spark, []))
    assert empty.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"] and not empty.collect()
    lone = [(c, 0, None, None) for c in range(1, 20)]  # no head: those with turns to lose keep none
    got = prefix_trie.prefix_trie(conversations(spark, lone)).collect()
    assert sorted((tuple(r) for r in got), key=str) == trie_reference(lone)


def test_find_close_skips_blocks():
    rng = random.Random(2)
    for n, block in ((1, 4), (5, 4), (700, 8), (3000, 64)):
        bits, depth = [], 0
        for left in range(2 * n, 0, -1):
            up = depth == 0 or (depth < left and rng.random() < 0.5)
            bits.append(up)
            depth += 1 if up else -1
        bits = [True, *bits, False]
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.array(bits)
        at = np.flatnonzero(opens)
        assert prefix_trie.Parens(opens, block).find_close(at).tolist() == [want[i] for i in at.tolist()]


# -- top-k search ---------------------------------------------------------------------------------


def top_reference(rows, size, k=5, step=50):
    used = as_longs(rows, 256.0, 0, size, 2**26)
    out = []
    for me, (q, x) in enumerate(used):
        if q is None or math.fmod(q, step):
            continue
        best = sorted((-sum(a * b for a, b in zip(x, y)), i is None, i or 0) for j, (i, y) in enumerate(used) if j != me)
        out += [(q, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(best[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [2, 6])
def test_top_k_equals_brute_force(spark, size):
    rows = odd_vectors(size)
    got = metric_tree.top_k(vectors(spark, rows).repartition(4), part=40, fanout=3, block=4).collect()
    assert sorted((tuple(r) for r in got), key=str) == top_reference(rows, size)


def test_top_k_few_rows_and_large_entries(spark):
    for rows in ([], [(7, [1.0])], [(0, [1.0]), (1, [1.0])], [(0, [2.6e5, 1.0]), (1, [2.6e5, 2.0]), (2, [-2.6e5, 2.5e5]), (50, [0.0, 0.0]), (3, [1e9, 0.0])]):
        got = metric_tree.top_k(vectors(spark, rows)).collect()
        assert sorted((tuple(r) for r in got), key=str) == top_reference(rows, 2)


def test_triangle_inequality_saves_products():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 4)) * 2000
    x = np.unique(np.concatenate([np.floor(c + rng.normal(size=(60, 4)) * 5) for c in centres]).astype(np.int64), axis=0)
    most = float((x * x).sum(axis=1).max())
    pages = metric_tree.load_pages(x, most, page=16)
    loaded = [p | {"centre": x[p["centre"]].tolist()} for p in pages]
    order = np.concatenate([p["rows"] for p in pages])
    at = np.cumsum([0] + [len(p["rows"]) for p in pages])
    ids = [[int(r)] for r in order]
    tree = metric_tree.PartTree(x[order], ids, most, [p | {"rows": np.arange(a, b)} for p, a, b in zip(loaded, at, at[1:])])
    made = 0
    for i in range(0, len(x), 100):
        best, n = tree.search(x[i], i, 5, None)
        made += n
        scores = x @ x[i]
        want = sorted(((int(s), -j) for j, s in enumerate(scores) if j != i), reverse=True)[:5]
        assert best == [(s, -j) for s, j in want]
    assert made < len(x) * len(range(0, len(x), 100)) / 2


def test_usable_rows(spark):
    got = {r.vec_id: r.x for r in usable(vectors(spark, odd_vectors()), 64.0).collect() if r.vec_id is not None}
    assert not {9000, 9001, 9002, 9003, 9050} & set(got) and got[9100] == [64, 0, 0, 0, 0, 0] and got[9150] == [0] * 6
