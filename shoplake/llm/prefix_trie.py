"""Shared prefixes of conversations: a trie in balanced parentheses per shard.

1. A turn is its role and text, known by their SHA-256; a conversation is the
   text of its turns' digests, ``WIDTH`` characters each, so that sorted
   conversations stand in the preorder of their trie.
2. Conversations are dealt by ranges of (digests, id) to shards of about
   ``SHARD_TURNS`` turns. A prefix or a conversation that a third of all rows
   share spreads over as many shards as it needs.
3. A shard writes its trie as parentheses: "(" enters a node, ")" leaves it.
   The excess (open minus closed) is kept with its least value per block and
   over blocks in a tree, so ``findclose`` skips blocks that stay inside a subtree. The
   interval it delimits gives a node's members from counts at its ends, its leaves
   from the rank of "()", its children by depth, and what sharing saves from
   a cumulative array.
4. Only nodes on the first or last path of a shard can go on in another one.
   Their parts (the spines) are summed by node and then over each node's
   ancestors; all other nodes are complete where they are. The ids that end
   in a spine node are hashed as one sorted stream of text pieces.

A conversation is one row of ``WIDTH`` characters a turn, and so has to fit in a
task; groups of conversations of any size do not.

Null and edge cases: a null role or text is empty; rows without ``conv_id``
belong to no conversation and are left out; turns go null first, ties by
role, then by digest; repeated rows are turns of their own; a conversation that
loses all its turns is a member of the root only; extra columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import written

WIDTH = 64
FAMILY = 20
SHARE = 4
SHARD_TURNS = 200_000
BLOCK = 64
PIECE_BYTES = 1 << 20
SPACE = r"[^\x20\x09-\x0D]+"


def shared_turns(conv_id: str = "conv_id") -> Column:
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % SHARE).cast("int")


def _turn_digest() -> Column:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, keys, words`` of each conversation, turns in order."""
    turn = F.struct(
        F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        _turn_digest().alias("key"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SPACE)).cast("int").alias("words"),
    )
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t")).where("conv_id is not null")
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return turns.select("conv_id", F.col("t.key").alias("keys"), F.col("t.words").alias("words"))


def rebuilt(paths: DataFrame, family: int = FAMILY) -> DataFrame:
    """Each conversation with the first turns of its family's head in place of its own."""
    most = SHARE - 1
    head = paths.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("_head"), F.slice("keys", 1, most).alias("_k"), F.slice("words", 1, most).alias("_w"))
    h = shared_turns()
    both = paths.join(head, F.col("conv_id") - F.col("conv_id") % family == F.col("_head"), "left")

    def turned(own: str, first: str) -> Column:
        begin = F.when(F.col(first).isNull() | (h == 0), F.slice(own, 1, 0)).otherwise(F.slice(first, F.lit(1), h))
        return F.concat(begin, F.slice(own, h + 1, F.greatest(F.size(own), F.lit(0))))

    return both.select("conv_id", turned("keys", "_k").alias("keys"), turned("words", "_w").alias("words"))


class Parens:
    """Balanced parentheses with the least excess of each block and, in a binary heap over the blocks, of runs of blocks."""

    def __init__(self, opens: np.ndarray, block: int = BLOCK):
        self.block = block
        self.size = 1 << max(0, int(-(-len(opens) // block) - 1).bit_length())
        self.excess = np.full(self.size * block, np.iinfo(np.int64).max)
        self.excess[: len(opens)] = np.cumsum(np.where(opens, 1, -1))
        self.least = np.empty(2 * self.size, dtype=np.int64)
        self.least[self.size :] = self.excess.reshape(self.size, block).min(axis=1)
        width = self.size
        while width > 1:
            self.least[width // 2 : width] = self.least[width : 2 * width].reshape(-1, 2).min(axis=1)
            width //= 2

    def _scan(self, at: np.ndarray, end: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """First place from ``at``, before ``end``, with an excess of at most ``goal``; -1 where there is none."""
        out, at, live = np.full(len(at), -1), at.copy(), np.flatnonzero(at < end)
        while len(live):
            hit = self.excess[at[live]] <= goal[live]
            out[live[hit]] = at[live[hit]]
            live = live[~hit]
            at[live] += 1
            live = live[at[live] < end[live]]
        return out

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The places that close the open parentheses at ``at``."""
        goal = self.excess[at] - 1
        out = self._scan(at + 1, (at // self.block + 1) * self.block, goal)
        far = np.flatnonzero(out < 0)
        goal, node = goal[far], at[far] // self.block + self.size
        live = np.arange(len(far))
        while len(live):  # up, until the run of blocks to the right goes low enough
            n = node[live]
            found = (n % 2 == 0) & (self.least[n ^ 1] <= goal[live])
            node[live] = np.where(found, n + 1, n // 2)
            live = live[~found]
        live = np.flatnonzero(node < self.size)
        while len(live):  # down, to its first such block
            n = 2 * node[live]
            node[live] = n + (self.least[n] > goal[live])
            live = live[node[live] < self.size]
        block = (node - self.size) * self.block
        out[far] = self._scan(block, block + self.block, goal)
        return out


class ShardTrie:
    """The trie of a shard's conversations, which come in order of (path, id)."""

    def __init__(self):
        self.opens = bytearray()
        self.convs: list[int] = []
        self.first_path = self.path = ""
        # per node, in preorder; convs_at: conversations before it
        self.depth, self.words, self.parent, self.place, self.convs_at = [], [], [], [], []
        self._stack: list[int] = []
        self._enter(0)

    def _enter(self, words: int) -> None:
        self.parent.append(self._stack[-1] if self._stack else -1)
        self._stack.append(len(self.depth))
        self.depth.append(len(self._stack) - 1)
        self.words.append(words)
        self.place.append(len(self.opens))
        self.convs_at.append(len(self.convs))
        self.opens.append(1)

    def add(self, conv: int, path: str, words: list[int]) -> None:
        turns, same = len(path) // WIDTH, 0
        while same < min(turns, len(self._stack) - 1) and path.startswith(self.path[same * WIDTH : (same + 1) * WIDTH], same * WIDTH):
            same += 1
        while len(self._stack) > same + 1:
            self._stack.pop()
            self.opens.append(0)
        for d in range(same, turns):
            self._enter(words[d])
        if not self.convs:
            self.first_path = path
        self.path = path
        self.convs.append(conv)

    def _marks(self, path: str) -> list[str]:
        """An id of each prefix of a path."""
        h, out = hashlib.sha256(), []
        for d in range(len(path) // WIDTH + 1):
            out.append(h.hexdigest()[:32])
            h.update(path[d * WIDTH : (d + 1) * WIDTH].encode())
        return out

    def rows(self) -> Iterator[dict]:
        """Complete nodes, parts of spine nodes, and the ids that end in spine nodes."""
        spine = dict(zip(range(len(self.first_path) // WIDTH + 1), self._marks(self.first_path)))
        spine |= dict(zip(self._stack, self._marks(self.path)))
        opens = np.frombuffer(bytes(self.opens) + b"\0" * len(self._stack), dtype=np.uint8).astype(bool)
        place = np.array(self.place)
        close = Parens(opens).find_close(place)
        opened = np.cumsum(opens)
        first, after = opened[place] - 1, opened[close]  # a node's subtree, in preorder
        on_spine = np.zeros(len(place), dtype=bool)
        on_spine[list(spine)] = True
        ids = np.array(self.convs, dtype=np.int64)
        before = np.array([*self.convs_at, len(ids)])
        n_convs = before[after] - before[first]
        least = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), np.stack((before[first], before[after]), axis=1).ravel())[::2]
        leaf = ~opens[place + 1]  # a pair "()"
        leaf_rank = np.concatenate(([0], np.cumsum(leaf & ~on_spine)))
        savings = np.concatenate(([0], np.cumsum(np.where(on_spine, 0, (n_convs - 1) * np.array(self.words, dtype=np.int64)))))
        parent = np.array(self.parent)
        children = np.bincount(parent[(parent >= 0) & ~on_spine], minlength=len(place))
        leaves, saved = leaf_rank[after] - leaf_rank[first], savings[after] - savings[first]
        for i in range(len(place)):
            ending = ids[before[i] : before[i + 1]].tolist()  # shorter paths sort first
            out = {"depth": self.depth[i], "conv_id": int(least[i]), "n_convs": int(n_convs[i]), "n_children": int(children[i]), "n_leaves": int(leaves[i]), "saved_tokens": int(saved[i])}
            if not on_spine[i]:
                p = self.parent[i]
                own = {"up": spine[p]} if on_spine[p] else {"parent_conv_id": int(least[p])}
                yield out | own | {"kind": "node", "ends_sha256": hashlib.sha256(",".join(map(str, ending)).encode()).hexdigest()}
                continue
            line, p = [spine[i]], self.parent[i]
            while p >= 0:
                line.append(spine[p])
                p = self.parent[p]
            yield out | {"kind": "spine", "line": line, "words": self.words[i], "leaf": bool(leaf[i])}
            step = PIECE_BYTES // 20  # an id has at most 20 characters
            for a in range(0, len(ending), step):
                yield {"kind": "ends", "line": line[:1], "conv_id": ending[a], "ids": ",".join(map(str, ending[a : a + step]))}


PARTS = "kind string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, up string, line array<string>, words long, leaf boolean, ids string"
_ARROW = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}[t]) for n, t in (c.split(" ") for c in PARTS.split(", "))])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = ShardTrie()
    for b in batches:
        for conv, path, words in zip(*(c.to_pylist() for c in b.columns)):
            trie.add(conv, path, words)
    if not trie.convs:
        return
    held, size = [], 0
    for row in trie.rows():
        held.append(row)
        size += 500 + len(row.get("ids", "")) + 40 * len(row.get("line", ()))
        if size > 4 * PIECE_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


def _hash_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each spine node's ids, whose pieces come in order."""
    pieces = (p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    for mark, own in groupby(pieces, key=lambda p: p[0]):
        h = hashlib.sha256(next(own)[1].encode())
        for _, more in own:
            h.update(b"," + more.encode())
        yield pa.RecordBatch.from_pydict({"mark": [mark], "ends_sha256": [h.hexdigest()]})


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per distinct prefix of rebuilt conversations."""
    spark = conversations.sparkSession
    paths = rebuilt(written(conversation_paths(conversations), "conversation-paths"))
    paths = written(paths.select(F.array_join("keys", "").alias("path"), "conv_id", "words"), "rebuilt-paths")
    turns = paths.select(F.sum(F.size("words"))).first()[0] or 0
    shards = max(-(-turns // shard_turns), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = paths.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = written(ranged.select("conv_id", "path", "words").mapInArrow(_shards, PARTS), "trie-parts")

    mark = F.col("line")[0].alias("mark")
    spine = parts.where("kind = 'spine'").groupBy(mark).agg(
        F.first("line").alias("line"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("words").alias("words"), F.bool_and("leaf").alias("leaf"),
    )
    spine = written(spine, "trie-spine")
    # a spine node counts for itself and for every node above it
    own = spine.select(F.posexplode("line").alias("up", "mark"), F.col("leaf").cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("own"))
    sums = own.groupBy("mark").agg(F.sum("leaf").alias("more_leaves"), F.sum("own").alias("more_saved"), F.count_if(F.col("up") == 1).alias("more_children"))
    pieces = parts.where("kind = 'ends'").select(mark, "ids", "conv_id").repartition("mark").sortWithinPartitions("mark", "conv_id").select("mark", "ids")
    ends = pieces.mapInArrow(_hash_stream, "mark string, ends_sha256 string")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    on_spine = spine.join(sums, "mark").join(ends, "mark", "left").select(
        "conv_id", "depth", F.get("line", F.lit(1)).alias("up"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", (F.col("n_children") + F.col("more_children")).alias("n_children"),
        (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("saved_tokens") + F.col("more_saved")).alias("saved_tokens"), F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )
    nodes = parts.where("kind = 'node'").select(*on_spine.columns).unionByName(on_spine)
    above = spine.select(F.col("mark").alias("up"), F.col("conv_id").alias("_above"))
    parent = F.coalesce("parent_conv_id", "_above").alias("parent_conv_id")
    return nodes.join(above, "up", "left").select("conv_id", "depth", parent, "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
