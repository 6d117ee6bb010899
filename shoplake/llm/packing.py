"""Sum-of-squares online packing of token ids into fixed windows.

A document's ids (and one closing id 0) are cut into full windows and one
remainder. Full windows stand alone. Remainders arrive online in packing
groups: a level array counts the partially filled windows at each fill level,
and a remainder goes to the level (or a new window) that makes the sum of the
squared counts least; ties go to the fullest level. Placing one costs a scan
of the level array.

Groups hold about ``GROUP`` remainders, dealt by a hash of the piece, so a
group is bounded, groups run in parallel and open windows at a group's end
are a small share. Only lengths and places are shuffled, never ids.

Tokenizers: the vocabulary is a rank file (``vocab``) read by its path on
each worker, with the JSON form's added token (``SPECIAL``); its ids are those
of the JSON form under ``tokenizers``, which a test compares.

Null and edge cases: a null text counts as empty and still has its closing
id; the added token's string inside a text is its one id; repeated rows are packed
each; ``doc_id`` may be null; other columns are ignored. An empty table gives
no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import written

WINDOW = 1024
GROUP = 32_768
VOCAB = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 0
#: The added token of byte_bpe_50k.json, which `tokenizers` matches inside text.
SPECIAL = {"<|endoftext|>": 50256}
PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long"


@lru_cache(maxsize=2)
def encoder(vocab: str) -> tiktoken.Encoding:
    with open(vocab, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(vocab, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_pieces(docs: DataFrame, vocab: str = VOCAB, window: int = WINDOW) -> DataFrame:
    """Every document's ids, cut into full windows and a remainder (``ids``: little-endian unsigned 32-bit)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab)

        def batch(rows):
            doc, start, length, ids, total = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                names=["doc_id", "start", "length", "ids", "doc_tokens"],
            )

        for b in batches:
            rows, held = [], 0
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encode.encode_to_numpy(text.as_py() or "", allowed_special="all"), END_ID).astype("<u4")
                for s in range(0, len(ids), window):
                    part = ids[s : s + window]
                    rows.append((doc_id, s, len(part), part.tobytes(), len(ids)))
                    held += part.nbytes
                    if held >= 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
            if rows:
                yield batch(rows)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, PIECE)


class LevelArray:
    """Counts of partially filled windows by fill level, and which windows they are."""

    def __init__(self, window: int = WINDOW):
        self.window, self.count, self.open, self.made = window, np.zeros(window + 1, dtype=np.int64), [[] for _ in range(window + 1)], 0

    def place(self, size: int) -> tuple[int, int]:
        """The window and the offset for a piece of ``size`` ids."""
        n, top = self.count, self.window
        if size >= top:
            self.made += 1
            return self.made - 1, 0
        level, best = 0, 2 * n[size] + 1  # a new window
        at = n[1 : top - size + 1]  # levels that have room
        held = np.flatnonzero(at)
        if len(held):
            after = n[held + 1 + size].copy()
            cost = 2 * (after - at[held]) + 2
            if held[-1] == top - size - 1:  # filled up: it leaves the array
                cost[-1] = 1 - 2 * at[held[-1]]
            k = len(cost) - 1 - int(np.argmin(cost[::-1]))
            if cost[k] <= best:
                level = int(held[k]) + 1
        if level:
            w = self.open[level].pop()
            n[level] -= 1
        else:
            w, self.made = self.made, self.made + 1
        if level + size < top:
            self.open[level + size].append(w)
            n[level + size] += 1
        return w, level


def pack(pieces: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (a written table: it is read twice)."""
    cols = pieces.columns
    rest = pieces.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group))
    order = F.xxhash64(*cols)
    rest = rest.withColumn("_o", order).withColumn("_g", F.pmod("_o", F.lit(groups)))

    def place(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("_o", kind="stable")
        levels = LevelArray(window)
        at = [levels.place(int(n)) for n in df["length"]]
        seq = np.array([a for a, _ in at], dtype=np.int64)
        df["sequence_id"] = ((df["_g"].to_numpy(dtype=np.int64) << 33) + seq) * 2 + 1
        df["offset"] = np.array([b for _, b in at], dtype=np.int64)
        df["doc_id"] = df["doc_id"].astype(object).where(df["doc_id"].notna(), None)
        return df[[*cols, "sequence_id", "offset"]]

    # ids travel as text so that null and large ids are exact in pandas
    schema = ", ".join(f"{f.name} {'string' if f.name == 'doc_id' else f.dataType.simpleString()}" for f in pieces.schema.fields)
    packed = rest.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("_g").applyInPandas(place, schema + ", sequence_id long, offset long")
    packed = packed.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    full = pieces.where(F.col("length") == window).withColumn("sequence_id", F.monotonically_increasing_id() * 2).withColumn("offset", F.lit(0).cast("bigint"))
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, vocab: str = VOCAB, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``)."""
    pieces = token_pieces(docs, vocab, window).withColumn("ids_crc32", F.crc32("ids"))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + (["ids"] if with_ids else [])
    return pack(written(pieces.select(*cols), "pieces"), window)
