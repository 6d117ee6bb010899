"""Benchmark decontamination with an FM-index per training shard.

Words of the documents become symbols of the test vocabulary (a word that no
test phrase holds is symbol 0, which no phrase can cross). A shard is a slice
of about ``SHARD_WORDS`` words of a task's documents; slices overlap by one
word less than a phrase, so no occurrence is lost and long documents are as
cheap as short ones. Per shard: suffixes sorted up to the next symbol 0, the
Burrows-Wheeler column in a wavelet matrix, backward search of all phrases at
once through its ranks, occurrences located by walking to sampled suffix
positions, hits merged into removal spans. Words are compared as hashes and
every hit word is verified byte by byte.

There is no shuffle. The test phrases are the stated query set: they go to
the tasks in blocks of at most ``BLOCK_BYTES``, one pass for each.

Null and edge cases: null and empty texts have no words; a null or wordless
item has no phrase; an item without id marks words but is not listed; equal
phrases of several items count for each; repeated item ids count once; all
input columns are kept (a column that clashes with a result's name is
replaced). An empty table gives no rows; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

PHRASE = 10
SHARD_WORDS = 1 << 20
CHUNK_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20
SAMPLE = 8
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=1)
def _tables():
    codes = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
    return codes


@lru_cache(maxsize=2)
def _powers(n: int):
    up = np.full(n + 1, _BASE, dtype=np.uint64)
    up[0] = 1
    down = np.full(n + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _power_of_two(n: int) -> int:
    return 1 << max(12, n.bit_length())


def words_of(low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of lower-cased UTF-8 bytes."""
    edge = np.diff(_IS_WORD[low].astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(_power_of_two(len(low)))
    sums = np.zeros(len(low) + 1, dtype=np.uint64)
    np.cumsum(_tables()[low] * up[: len(low)], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start]
    h ^= h >> np.uint64(29)
    return start, end, h * np.uint64(0xBF58476D1CE4E5B9) + (end - start).astype(np.uint64)


def _chunks(low: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts between words, about ``CHUNK_BYTES`` apart."""
    a, n = 0, len(low)
    while a < n:
        b = min(n, a + CHUNK_BYTES)
        if b < n:
            gaps = np.flatnonzero(~_IS_WORD[low[a:b]])
            if len(gaps):
                b = a + int(gaps[-1]) + 1
            else:
                more = np.flatnonzero(~_IS_WORD[low[b:]])
                b = b + int(more[0]) + 1 if len(more) else n
        yield a, b
        a = b


def words_of_bytes(raw: bytes):
    low = _LOWER[np.frombuffer(raw, dtype=np.uint8)]
    parts = [(s + a, e + a, h) for a, b in _chunks(low) for s, e, h in [words_of(low[a:b])]]
    if not parts:
        return low, *(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.uint64))
    return low, *(np.concatenate(x) for x in zip(*parts))


@dataclass
class Phrases:
    """Test phrases of one block: symbols by length, and which items hold each."""

    vocab: list[bytes] = field(default_factory=list)  # symbol - 1 -> word
    hashes: np.ndarray = None  # sorted
    symbols: np.ndarray = None  # of the sorted hashes
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # length -> symbols, phrase numbers
    items: list[list[str]] = field(default_factory=list)  # phrase number -> item ids

    @classmethod
    def of(cls, items: list[tuple[object, str | None]], size: int = PHRASE) -> Phrases:
        out, numbers, symbol = cls(), {}, {}
        for item_id, text in items:
            words = WORD.findall((text or "").encode().lower())
            for i in range(max(1, len(words) - size + 1) if words else 0):
                key = tuple(symbol.setdefault(w, len(symbol) + 1) for w in words[i : i + size])
                if key not in numbers:
                    numbers[key] = len(out.items)
                    out.items.append([])
                if item_id is not None and str(item_id) not in out.items[numbers[key]]:
                    out.items[numbers[key]].append(str(item_id))
        out.vocab = list(symbol)
        h = words_of(np.frombuffer(b" ".join(out.vocab), dtype=np.uint8))[2] if symbol else np.zeros(0, dtype=np.uint64)
        order = np.argsort(h)
        out.hashes, out.symbols = h[order], (order + 1).astype(np.int64)
        for n in sorted({len(k) for k in numbers}):
            keys = [k for k in numbers if len(k) == n]
            out.by_length[n] = np.array(keys, dtype=np.int64), np.array([numbers[k] for k in keys])
        return out

    @property
    def longest(self) -> int:
        return max(self.by_length, default=1)

    def encode(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(h), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.symbols[at], 0)


def suffix_order(s: np.ndarray, run: np.ndarray, top: int) -> np.ndarray:
    """Positions of nonzero symbols, sorted by their symbols up to the next 0, then by position.

    The first key packs as many symbols as fit 63 bits; tied groups that go on
    are sorted again by the ranks behind them, each time twice as deep.
    """
    n, bits = len(s), max(1, int(top).bit_length())
    k = min(63 // bits, 16)
    pos = np.flatnonzero(s)
    key = np.zeros(len(pos), dtype=np.uint64)
    padded = np.append(s, np.zeros(k, dtype=s.dtype))
    for j in range(k):
        key = (key << np.uint64(bits)) | np.where(run[pos] > j, padded[pos + j], 0).astype(np.uint64)
    o = np.argsort(key, kind="stable")
    order, key = pos[o], key[o]
    slot = np.arange(len(order))
    first = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), slot, 0)) if len(order) else slot
    rank = np.zeros(n + 1, dtype=np.int64)
    rank[order] = first + 1
    depth = k
    while len(order):
        size = np.bincount(first, minlength=len(order))
        goes = (size[first] > 1) & (np.maximum.reduceat(run[order], np.flatnonzero(first == slot))[np.cumsum(first == slot) - 1] > depth)
        act = np.flatnonzero(goes)
        if not len(act):
            return order
        p = order[act]
        behind = np.where(run[p] > depth, rank[np.minimum(p + depth, n)], 0)
        # groups stay in their slots; the order inside a group changes
        o = np.lexsort((p, behind, first[act]))
        p, behind, g = p[o], behind[o], first[act][o]
        order[act] = p
        new = np.append(True, (g[1:] != g[:-1]) | (behind[1:] != behind[:-1]))
        first[act] = np.maximum.accumulate(np.where(new, act, 0))
        rank[p] = first[act] + 1
        depth *= 2
    return order


class FMIndex:
    """Backward search and location over the nonzero symbols of ``s``."""

    def __init__(self, s: np.ndarray, top: int):
        n = len(s)
        zero = np.append(np.flatnonzero(s == 0), n)
        run = zero[np.searchsorted(zero, np.arange(n))] - np.arange(n)
        sa = suffix_order(s, run, top)
        before = np.append(0, s)  # before[p] is the symbol left of p
        self.last = before[sa]
        self.count = np.append(0, np.cumsum(np.bincount(s[sa], minlength=top + 1)))
        # suffixes whose next symbol is 0 come first among those of their symbol
        ends = np.append(s[1:], 0) == 0
        self.skip = np.bincount(s[ends & (s > 0)], minlength=top + 1)
        self.levels, col = [], self.last
        for b in range(int(top).bit_length() - 1, -1, -1):
            bit = (col >> b) & 1
            ones = np.zeros(len(col) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((b, ones, len(col) - int(ones[-1])))
            col = np.concatenate((col[bit == 0], col[bit == 1]))
        self.sampled = (self.last == 0) | (sa % SAMPLE == 0)
        at = np.cumsum(self.sampled) - 1
        self.sample_at, self.samples = at, sa[self.sampled]

    def _rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``c`` is among the first ``i`` of the last column."""
        z = np.zeros_like(i)
        for b, ones, zeros in self.levels:
            one = ((c >> b) & 1).astype(bool)
            i, z = np.where(one, zeros + ones[i], i - ones[i]), np.where(one, zeros + ones[z], z - ones[z])
        return i - z

    def step(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.count[c] + self.skip[c] + self._rank(c, i)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row range of each phrase (rows of symbols)."""
        c = phrases[:, -1]
        lo, hi = self.count[c].copy(), self.count[c + 1].copy()
        live = np.flatnonzero(hi > lo)
        for j in range(phrases.shape[1] - 2, -1, -1):
            if not len(live):
                break
            c = phrases[live, j]
            lo[live], hi[live] = self.step(c, lo[live]), self.step(c, hi[live])
            live = live[hi[live] > lo[live]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, row, steps = np.zeros(len(rows), dtype=np.int64), rows.copy(), 0
        live = np.arange(len(rows))
        while len(live):
            hit = self.sampled[row[live]]
            done = live[hit]
            out[done] = self.samples[self.sample_at[row[done]]] + steps
            live = live[~hit]
            row[live] = self.step(self.last[row[live]], row[live])
            steps += 1
        return out


def shard_hits(s: np.ndarray, phrases: Phrases, shard_words: int = SHARD_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and phrase number of every occurrence in the symbol stream."""
    found, over = [], phrases.longest - 1
    for a in range(0, max(1, len(s)), shard_words):
        part = s[a : a + shard_words + over]
        if not part.any():
            continue
        index = FMIndex(part, len(phrases.vocab))
        for n, (keys, numbers) in phrases.by_length.items():
            lo, hi = index.search(keys)
            size = hi - lo
            rows = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            if len(rows):
                found.append((index.locate(rows) + a, np.full(len(rows), n), np.repeat(numbers, size)))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found))


def scan(texts: list[bytes], phrases: Phrases, shard_words: int = SHARD_WORDS):
    """Per text: words, hit words, byte spans of merged hits, ids of the items found."""
    raw = b"\0".join(texts)  # NUL ends every word
    low, start, end, h = words_of_bytes(raw)
    bound = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(start, bound)  # first word of each text
    words = np.diff(first)
    s = phrases.encode(h)
    doc_of = np.repeat(np.arange(len(texts)), words)
    # a 0 between texts: word i of text d is at i + d of the stream
    stream = np.zeros(len(s) + len(texts), dtype=np.int64)
    stream[np.arange(len(s)) + doc_of] = s
    while True:
        at, length, number = shard_hits(stream, phrases, shard_words)
        cover = np.zeros(len(stream) + 1, dtype=np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
        hit = np.cumsum(cover[:-1]) > 0
        w = np.flatnonzero(hit[np.arange(len(s)) + doc_of])
        body = low.tobytes()
        wrong = [i for i in w.tolist() if body[start[i] : end[i]] != phrases.vocab[s[i] - 1]]
        if not wrong:
            break
        stream[np.array(wrong) + doc_of[wrong]] = 0  # another word with the same hash
    items: list[set[str]] = [set() for _ in texts]
    text_at = np.searchsorted(first + np.arange(len(texts) + 1), at, side="right") - 1
    pairs = np.unique(text_at * (len(phrases.items) + 1) + number) if len(at) else []
    for p in np.asarray(pairs).tolist():
        items[p // (len(phrases.items) + 1)].update(phrases.items[p % (len(phrases.items) + 1)])
    new = np.append(True, (np.diff(w) > 1) | (np.diff(doc_of[w]) > 0)) if len(w) else np.zeros(0, dtype=bool)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(w)) - 1 if len(w) else heads
    out, hit_words = [[] for _ in texts], np.bincount(doc_of[w], minlength=len(texts))
    for a, b in zip(w[heads].tolist(), w[tails].tolist()):
        d = doc_of[a]
        out[d].append((int(start[a] - bound[d]), int(end[b] - bound[d])))
    return words, hit_words, out, items


def _merge(spans: list[tuple[int, int]], raw: bytes) -> tuple[list[tuple[int, int]], int]:
    """Union of spans of several passes (joined where no word lies between) and its words."""
    low = raw.lower()
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and (a <= merged[-1][1] or not WORD.search(low, merged[-1][1], a)):
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [tuple(x) for x in merged], sum(len(WORD.findall(low[a:b])) for a, b in merged)


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


RESULT = ("n_words", "n_hit", "items", "span_starts", "span_ends")


def find_leaks(docs: DataFrame, benchmark: DataFrame, phrase: int = PHRASE, block_bytes: int = BLOCK_BYTES, cut: bool = False, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with ``n_words, n_hit, items`` (ids as text, sorted) and removal spans in UTF-8 bytes.

    With ``cut`` the spans are removed from ``text`` and ``n_chars``, where there is one, follows.
    """
    keep = [c for c in docs.columns if c.lower() not in RESULT]
    docs = docs.select(*keep)
    bench = benchmark.select("item_id", "text").where("text is not null")
    total = bench.select(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    schema = StructType([*docs.schema.fields, StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("items", ArrayType(StringType())), StructField("span_starts", ArrayType(LongType())), StructField("span_ends", ArrayType(LongType()))])
    out = docs
    for k in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        phrases = Phrases.of([tuple(r) for r in part.collect()], phrase)
        out = out.mapInArrow(_pass(phrases, keep, k > 0, cut and k == blocks - 1, shard_words), schema)
    return out


def _pass(phrases: Phrases, keep: list[str], again: bool, cut: bool, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            a, n = 0, whole.num_rows
            sizes = [len(v.as_buffer()) if v.is_valid else 0 for v in whole.column(keep.index("text")).cast(pa.binary())]
            while a < n:
                b, held = a, 0
                while b < n and (b == a or held + sizes[b] <= CHUNK_BYTES):
                    held += sizes[b]
                    b += 1
                yield part(whole.slice(a, b - a))
                a = b

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column(keep.index("text"))
        raw = [v or b"" for v in text.cast(pa.binary()).to_pylist()]
        words, hits, spans, items = scan(raw, phrases, shard_words)
        hits = hits.tolist()
        if again:
            old = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in RESULT[2:]]
            for i, (it, starts, ends) in enumerate(zip(*old)):
                items[i].update(it)
                if starts:
                    spans[i], hits[i] = _merge(spans[i] + list(zip(starts, ends)), raw[i])
        cols = {f: batch.column(batch.schema.get_field_index(f)) for f in keep}
        if cut and any(spans):
            new = [v if not sp else without(r, sp).decode() for v, r, sp in zip(text.to_pylist(), raw, spans)]
            cols["text"] = pa.array(new, text.type)
            if "n_chars" in cols:
                t = cols["n_chars"].type
                cols["n_chars"] = pa.array([len(v) if sp else o for v, sp, o in zip(new, spans, cols["n_chars"].to_pylist())], t)
        cols |= {
            "n_words": pa.array(words, pa.int64()),
            "n_hit": pa.array(hits, pa.int64()),
            "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            "span_starts": pa.array([[a for a, _ in x] for x in spans], pa.list_(pa.int64())),
            "span_ends": pa.array([[b for _, b in x] for x in spans], pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def leak_digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def brute_force(text: str | None, items: list[tuple[object, str | None]], size: int = PHRASE):
    """What the operator must give for one document, by comparing words (for tests)."""
    words = WORD.findall((text or "").encode().lower())
    hit, found = set(), set()
    for item_id, t in items:
        iw = WORD.findall((t or "").encode().lower())
        for i in range(max(1, len(iw) - size + 1) if iw else 0):
            w = iw[i : i + size]
            for j in range(len(words) - len(w) + 1):
                if words[j : j + len(w)] == w:
                    hit.update(range(j, j + len(w)))
                    if item_id is not None:
                        found.add(str(item_id))
    ids = ",".join(sorted(found))
    return len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)
