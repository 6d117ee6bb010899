"""Removal of repeated byte strings by depth-limited most-significant-digit passes over suffixes.

A suffix matters only through its first ``LENGTH`` bytes. Passes sort
suffixes by ever deeper digits and go on only with those that still share
one; the groups that are equal at the last depth are the repeated strings.

1. Windows of ``LENGTH`` bytes are filed under an anchor, the ``DIGIT``-byte
   string inside them with the least hash (leftmost of equals). Equal windows
   have equal anchors at equal places, so one row per anchor, about 1 in 140
   positions, stands for a run of windows. First digit: the anchor string.
   Rows alone with theirs hold no repeat and go.
2. Rows of one digit whose whole runs of windows are equal repeat wholly.
   Where runs differ, one row of each kind goes on, cut into blocks of
   ``BLOCK`` windows. Second digit: the bytes that a block's windows share.
   Blocks alone go, equal blocks repeat wholly.
3. Of blocks that share the digit and differ, single windows are compared at
   full depth.

Every pass is a grouping with a partial step and a join back, so a passage
that a third of all documents share costs a few rows per task; no group is
gathered. Strings are compared by two independent 64-bit polynomial hashes.
Texts move twice, for the bytes around undecided anchors and for the cut.

Null and edge cases: a null text is empty; texts shorter than ``LENGTH``
stay; a row repeated with its ``doc_id`` counts as another place; null ids
are one value; runs of one byte are overlapping repeats of themselves; extra
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import text_or_empty, written

LENGTH = 400
DIGIT = 128
BLOCK = 16
PIECE = 1_000_000
_POS_BITS = 20
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@lru_cache(maxsize=2)
def _tables(k: int):
    codes = np.random.default_rng(101 + k).integers(1, 1 << 63, 256, dtype=np.uint64)
    n = 1 << _POS_BITS
    up = np.full(n, _BASES[k], dtype=np.uint64)
    down = np.full(n, pow(_BASES[k], -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return codes, np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Hasher:
    """Hashes of substrings of up to 2**20 bytes, from prefix sums."""

    def __init__(self, b: np.ndarray, k: int):
        codes, up, self.down = _tables(k)
        self.sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(codes[b] * up[: len(b)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mix((self.sums[size:] - self.sums[:-size]) * self.down[:n])


def sliding_least(v: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` neighbours, from prefix and suffix minima of blocks."""
    n = len(v)
    x = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    x[:n] = v
    x = x.reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    k = n - w + 1
    return np.minimum(back[:k], ahead[w - 1 : w - 1 + k])


def anchors_of(pieces: list[bytes], length: int, digit: int):
    """Per run of windows with one anchor: digit, hash of the run, piece, first window, windows - 1, anchor - first window."""
    b = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    size = np.array([len(p) for p in pieces])
    end = np.cumsum(size)
    first, second = Hasher(b, 0), Hasher(b, 1)
    q = first.all(digit)
    low = np.uint64((1 << _POS_BITS) - 1)
    least = sliding_least((q & ~low) | np.arange(len(q), dtype=np.uint64), length - digit + 1)
    at = (least & low).astype(np.int64)
    s = np.arange(len(at))
    doc = np.repeat(np.arange(len(pieces)), size)[: len(at)]
    ok = s + length <= end[doc]
    s, at, doc = s[ok], at[ok], doc[ok]
    head = np.flatnonzero(np.append(True, (np.diff(at) != 0) | (np.diff(doc) != 0)))
    tail = np.append(head[1:], len(s)) - 1
    s0, s1, p, doc = s[head], s[tail], at[head], doc[head]
    shape = _mix(((p - s0) * 1024 + (s1 - s0)).astype(np.uint64) * np.uint64(_BASES[1]))
    return q[p], second.of(s0, s1 + length) ^ shape, doc, s0 - (end - size)[doc], s1 - s0, p - s0


def _batch(names: list[str], cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(np.ascontiguousarray(c).view(np.int64), pa.int64()) for c in cols], names=names)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """``k, id, raw``: a row's key is its text's hash with its doc_id, so a clash of hashes joins nothing wrong."""
    body = text_or_empty(text)
    return docs.select(F.xxhash64(body).alias("k"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), body.cast("binary").alias("raw"))


def _anchor_rows(length: int, digit: int):
    names = ["digit", "hull", "k", "id", "at"]

    def emit(docs, held):
        d, h, piece, s0, n, off = anchors_of([x[3] for x in held], length, digit)
        k, i, base = (np.array([x[j] for x in held], dtype=np.int64) for j in range(3))
        return _batch(names, [d, h, k[piece], i[piece], (s0 + base[piece]) << 20 | n << 10 | off])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, total = [], 0
            for k, i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                raw = raw.as_py()
                step = PIECE - length
                for a in range(0, max(1, len(raw) - length + 1), step):
                    part = raw[a : a + step + length - 1]  # all windows that start in this step
                    if total + len(part) > PIECE and held:
                        yield emit(b, held)
                        held, total = [], 0
                    held.append((k, i, a, part))
                    total += len(part)
            if held:
                yield emit(b, held)

    return run, "digit long, hull long, k long, id long, at long"


def _kinds(rows: DataFrame, digit: list[str], hull: str) -> DataFrame:
    """``rows`` with ``same`` (rows of its kind: equal digit and hull) and ``kinds`` (of its digit); lonely rows go."""
    one = rows.groupBy(*digit, hull).agg(F.count(F.lit(1)).alias("same"))
    kinds = one.groupBy(*digit).agg(F.count(F.lit(1)).alias("kinds"))
    return rows.join(one.join(kinds, digit).where("same > 1 or kinds > 1"), [*digit, hull])


def _regions(length: int):
    """The bytes of each undecided run of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            size = 0
            for k, i, raw, ats in zip(*(b.column(j) for j in range(4))):
                raw = raw.as_py()
                for at in ats.as_py():
                    s0, n = at >> 20, (at >> 10) & 1023
                    out.append((k.as_py(), i.as_py(), at, raw[s0 : s0 + n + length]))
                    size += n + length
                    if size > 4 << 20:
                        yield table(out)
                        out, size = [], 0
            if out:
                yield table(out)

    def table(out):
        k, i, at, region = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(i, pa.int64()), pa.array(at, pa.int64()), pa.array(region, pa.binary())], names=["k", "id", "at", "region"])

    return run


def _joined(b: pa.RecordBatch, limit: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Slices of a batch with their regions joined: bytes, place of each region."""
    col = b.column(b.schema.get_field_index("region"))
    size = np.array([len(x.as_buffer()) for x in col], dtype=np.int64)
    a = 0
    while a < len(size):
        n = max(1, int(np.searchsorted(np.cumsum(size[a:]), limit, side="right")))
        part = b.slice(a, n)
        body = b"".join(x.as_py() for x in part.column(b.schema.get_field_index("region")))
        yield np.frombuffer(body, dtype=np.uint8), np.cumsum(size[a : a + n]) - size[a : a + n], part
        a += n


def _shape(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    k, i, at = (part.column(j).to_numpy() for j in range(3))
    return k, i, at, (at >> 10) & 1023, at & 1023


def _expand(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers repeated ``count`` times, and 0, 1, ... within each."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def _block_rows(length: int, block: int):
    """Blocks are cut by distance before the anchor, so equal windows fall in equal blocks."""
    names = ["core1", "core2", "hull", "k", "id", "at", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for body, base, part in _joined(b):
                k, i, at, n, off = _shape(part)
                h1, h2 = Hasher(body, 0), Hasher(body, 1)
                near, far = (off - n) // block, off // block  # blocks of the last and the first window
                r, j = _expand(far - near + 1)
                j = j + near[r]
                lo = np.maximum(off[r] - block * j - block + 1, 0)  # windows of the block, from the region's start
                hi = np.minimum(off[r] - block * j, n[r])
                c0 = off[r] - block * j  # the block's windows share [c0, c0 - block + 1 + length)
                x = base[r]
                shape = _mix(((hi - lo) * 64 + (c0 - hi)).astype(np.uint64) * np.uint64(_BASES[1]))
                core = x + c0, x + c0 - block + 1 + length
                yield _batch(names, [h1.of(*core), h2.of(*core) ^ j.astype(np.uint64), h2.of(x + lo, x + hi + length) ^ shape, k[r], i[r], at[r], j])

    return run, "core1 long, core2 long, hull long, k long, id long, at long, block long"


def _window_rows(length: int, block: int):
    names = ["w1", "w2", "k", "id", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for body, base, part in _joined(b):
                k, i, at, n, off = _shape(part)
                blocks = part.column(4)
                r, _ = _expand(np.array([len(x) for x in blocks], dtype=np.int64))
                j = np.array(blocks.flatten().to_numpy(), dtype=np.int64)
                lo = np.maximum(off[r] - block * j - block + 1, 0)
                hi = np.minimum(off[r] - block * j, n[r])
                rr, t = _expand(hi - lo + 1)
                s = lo[rr] + t
                r = r[rr]
                x = base[r] + s
                h1, h2 = Hasher(body, 0), Hasher(body, 1)
                yield _batch(names, [h1.of(x, x + length), h2.of(x, x + length), k[r], i[r], (at[r] >> 20) + s])

    return run, "w1 long, w2 long, k long, id long, start long"


def repeated_spans(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT, block: int = BLOCK, text: str = "text") -> DataFrame:
    """``k, id, starts, ends``: covered bytes of every document that has some, as unmerged spans."""
    if not (1 <= digit < length <= 900 and 1 <= block <= 64):
        raise ValueError("needs digit < length <= 900 and block <= 64")
    raw = _keyed(docs, text)
    run, schema = _anchor_rows(length, digit)
    rows = written(raw.where(F.length("raw") >= length).mapInArrow(run, schema), "anchors")
    shared = rows.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digit")
    rows = written(rows.join(shared, "digit", "left_semi"), "shared-anchors")
    rows = written(_kinds(rows, ["digit"], "hull"), "anchor-kinds")
    first, count = F.shiftright("at", 20), F.shiftright("at", 10).bitwiseAND(F.lit(1023))
    whole = rows.where("same > 1").select("k", "id", first.alias("s"), (first + count + length).alias("e"))

    asked = rows.where("kinds > 1").dropDuplicates(["digit", "hull"]).groupBy("k", "id").agg(F.collect_list("at").alias("ats"))
    regions = written(raw.join(asked, ["k", "id"]).select("k", "id", "raw", "ats").mapInArrow(_regions(length), "k long, id long, at long, region binary"), "regions")

    run, schema = _block_rows(length, block)
    blocks = written(_kinds(regions.mapInArrow(run, schema), ["core1", "core2"], "hull"), "blocks")
    off = F.col("at").bitwiseAND(F.lit(1023))
    lo = F.greatest(off - F.col("block") * block - (block - 1), F.lit(0))
    hi = F.least(off - F.col("block") * block, count)
    even = blocks.where("same > 1").select("k", "id", (first + lo).alias("s"), (first + hi + length).alias("e"))

    left = blocks.where("kinds > 1").dropDuplicates(["core1", "core2", "hull"])
    left = left.groupBy("k", "id", "at").agg(F.collect_list("block").alias("blocks"))
    run, schema = _window_rows(length, block)
    windows = written(regions.join(left, ["k", "id", "at"]).select("k", "id", "at", "region", "blocks").mapInArrow(run, schema), "windows")
    twice = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    single = windows.join(twice, ["w1", "w2"], "left_semi").select("k", "id", F.col("start").alias("s"), (F.col("start") + length).alias("e"))

    spans = whole.unionByName(even).unionByName(single).distinct()
    return spans.groupBy("k", "id").agg(F.collect_list("s").alias("starts"), F.collect_list("e").alias("ends"))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered runs (spans that touch are one run)."""
    o = np.argsort(starts, kind="stable")
    s, e = starts[o], np.maximum.accumulate(ends[o])
    new = np.append(True, s[1:] > e[:-1])
    return s[new], e[np.append(new[1:], True)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out, held = [], 0
        for doc_id, raw, starts, ends in zip(*(b.column(j) for j in range(4))):
            raw = raw.as_py()
            s, e = [], []
            if starts.is_valid:
                s, e = merged(starts.values.to_numpy(), ends.values.to_numpy())
            kept = b"".join(raw[x:y] for x, y in zip([0, *e], [*s, len(raw)]))
            out.append((doc_id.as_py(), len(raw), len(raw) - len(kept), len(s), kept))
            held += len(kept)
            if held > 8 << 20:
                yield _kept(out)
                out, held = [], 0
        if out:
            yield _kept(out)


def _kept(out: list[tuple]) -> pa.RecordBatch:
    doc_id, n, gone, spans, kept = zip(*out)
    sha = [hashlib.sha256(x).hexdigest() for x in kept]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha), pa.array(kept, pa.binary())],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT, block: int = BLOCK, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes that stay)."""
    spans = repeated_spans(docs, length, digit, block, text)
    raw = _keyed(docs, text).withColumn("doc_id", F.when(F.col("id") != -(1 << 63), F.col("id")))
    return raw.join(spans, ["k", "id"], "left").select("doc_id", "raw", "starts", "ends").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """The same by counting every string (for tests)."""
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in raw:
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out
