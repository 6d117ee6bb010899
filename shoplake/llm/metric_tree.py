"""Exact top-k by inner product with best-first search in an M-tree.

Metric: each vector gets one more entry that lifts it to the greatest norm
``M`` of the table (queries get 0 there). Then
``distance(q, x)^2 = |q|^2 + M^2 - 2 <q, x>``: the nearest vectors are those of
the highest product, and Euclid's triangle inequality holds.

Build: equal vectors are one entry with its ``k + 1`` least ids. Nodes with more than
``PART`` entries are split, level by level, by the nearest of at most ``FANOUT`` routing
entries of their own; what is still too large is dealt into parts by hash.
Each part is bulk-loaded in one task into pages of at most ``PAGE`` entries. An
entry of a page has its covering radius and its distance to the page's own
routing vector (the parent distance).

Search: all queries go down the upper levels together, a join a level. First to
the nearest part, which gives a bound, then to all parts that the bound leaves. A node
whose parent distance shows by the triangle inequality that it is too far is
left without computing its distance. Within a part, a query opens pages in
order of their least possible distance until none can beat the k-th product found;
entries that the parent distance excludes are not computed. Products are
exact integers; bounds have room for rounding, so ties are kept and decided by id.

Queries meet a part in blocks of ``QUERIES``, so a part or a query list of any
size spreads over tasks.

Null and edge cases: vectors that are null or hold null, non-finite or
(``LIMIT``) too large entries take no part; shorter vectors count as filled up
with zeros; a null id is a candidate (after all others among ties) and never a query;
a row repeated with its id is another candidate; fewer candidates than ``k``
give fewer rows; extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplake.llm.common import written
from shoplake.llm.vectors import matrix, usable

FACTOR = 256.0
#: Scaled entries below this keep products of up to 2048 dimensions within a long.
LIMIT = float(1 << 26)
TOP = 5
STEP = 50
PART = 2000
FANOUT = 64
PAGE = 128
QUERIES = 512
#: Relative room for rounding in squared distances.
SLACK = 1e-11


class Space:
    """Distances between lifted vectors, in numpy."""

    def __init__(self, x: np.ndarray, most: float):
        self.x = x.astype(np.float64)
        self.sq = (self.x * self.x).sum(axis=1)
        self.lift = np.sqrt(np.maximum(most - self.sq, 0))

    def to(self, some: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Distances of rows ``some`` to the rows ``one``, as a matrix."""
        dot = self.x[some] @ self.x[one].T + np.outer(self.lift[some], self.lift[one])
        full = (self.sq + self.lift**2)
        return np.sqrt(np.maximum(full[some][:, None] + full[one][None, :] - 2 * dot, 0))


def load_pages(x: np.ndarray, most: float, page: int = PAGE) -> list[dict]:
    """Pages of an M-tree over the rows of ``x``; page 0 is the root; ``centre`` is the row of a page's routing vector."""
    space = Space(x, most)
    pages: list[dict] = []
    waiting = [(np.arange(len(x)), int(np.argmin(space.to(np.arange(len(x)), np.array([0]))[:, 0])), -1, -1)]
    while waiting:
        rows, centre, above, entry = waiting.pop()
        number = len(pages)
        if above >= 0:
            pages[above]["child"][entry] = number
        from_centre = space.to(rows, np.array([centre]))[:, 0]
        if len(rows) <= page:
            o = np.argsort(from_centre, kind="stable")
            pages.append({"leaf": True, "centre": centre, "rows": rows[o], "parent_distance": from_centre[o], "radius": np.zeros(len(rows)), "child": np.full(len(rows), -1)})
            continue
        want = min(page, -(-2 * len(rows) // page))
        order = np.argsort(from_centre, kind="stable")
        routes = rows[order[np.linspace(0, len(rows) - 1, want).astype(int)]]
        near = space.to(rows, routes)
        group = near.argmin(axis=1)
        if np.bincount(group).max() > 0.9 * len(rows):  # one route takes nearly all: shells around the centre instead
            group = np.empty(len(rows), dtype=int)
            group[order] = np.arange(len(rows)) * want // len(rows)
            routes = np.array([rows[group == g][0] for g in range(want)])
            near = space.to(rows, routes)
        kept = np.unique(group)
        routes = routes[kept]
        radius = np.array([near[group == g, g].max() for g in kept])
        pages.append({"leaf": False, "centre": centre, "rows": routes, "parent_distance": space.to(routes, np.array([centre]))[:, 0], "radius": radius, "child": np.full(len(routes), -1)})
        waiting += [(rows[group == g], int(r), number, i) for i, (g, r) in enumerate(zip(kept, routes))]
    return pages


class PartTree:
    """A part's pages, opened for search."""

    def __init__(self, x: np.ndarray, ids: list, most: float, pages: list[dict]):
        self.x, self.ids, self.most, self.pages = x, ids, most, pages
        small = float(np.abs(x).max(initial=0)) ** 2 * max(1, x.shape[1]) < 2**52
        self.kind = np.float64 if small else np.int64  # products of either are exact
        self.typed = x.astype(self.kind)
        self.vectors = [self.typed[p["rows"]] for p in pages]
        self.root = np.array(pages[0]["centre"], dtype=float)

    def search(self, q: np.ndarray, own: int | None, k: int, floor: int | None) -> tuple[list[tuple[int, int | None]], int]:
        """The ``k`` best ``(product, id)`` that reach ``floor``, and the number of products computed."""
        typed, qf = q.astype(self.kind), q.astype(float)
        base = float(qf @ qf) + self.most
        room = SLACK * (base + self.most)
        best: list[tuple[int, int, int]] = []  # heap of the k best, worst first
        floor = -(1 << 63) if floor is None else floor
        reach = np.sqrt(max(0.0, base - 2.0 * floor + room))
        at_root = np.sqrt(max(0.0, base - 2.0 * float(qf @ self.root)))
        waiting, made = [(0.0, 0, at_root)], 1
        while waiting:
            least, number, at_centre = heapq.heappop(waiting)
            if least > reach:
                break
            page = self.pages[number]
            open_ = np.flatnonzero(np.abs(at_centre - page["parent_distance"]) - page["radius"] <= reach + np.sqrt(room))
            if not len(open_):
                continue
            made += len(open_)
            products = self.vectors[number][open_] @ typed
            if not page["leaf"]:
                d = np.sqrt(np.maximum(base - 2.0 * products, 0))
                for low, i, at in zip((d - page["radius"][open_]).tolist(), open_.tolist(), d.tolist()):
                    if low <= reach + np.sqrt(room):
                        heapq.heappush(waiting, (max(0.0, low - np.sqrt(room)), int(page["child"][i]), at))
                continue
            for j in np.flatnonzero(products >= floor).tolist():
                value, row = int(products[j]), int(page["rows"][open_[j]])
                if value < floor:
                    continue
                names = list(self.ids[row])
                if own in names and np.array_equal(self.x[row], q):
                    names.remove(own)
                for name in names[:k]:
                    one = (value, name is not None, -name if name is not None else 0)
                    if len(best) < k:
                        heapq.heappush(best, one)
                    elif one > best[0]:
                        heapq.heapreplace(best, one)
                    else:
                        break
                if len(best) == k and best[0][0] > floor:
                    floor = best[0][0]
                    reach = np.sqrt(max(0.0, base - 2.0 * floor + room))
        return [(v, -n if known else None) for v, known, n in sorted(best, reverse=True)], made


def entries_of(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with their ``keep`` least ids (nulls last)."""
    w = Window.partitionBy("x").orderBy(F.col("vec_id").asc_nulls_last())
    first = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= keep)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("_r", "vec_id"))), lambda s: s["vec_id"])
    return first.groupBy("x").agg(ids.alias("ids"))


@dataclass
class MTree:
    """Upper levels ``up, child, route, radius, parent_distance``, of which the last leads to parts, and the pages of the parts."""

    levels: list[DataFrame]
    pages: DataFrame
    root: list[int]
    most: float


def _nearest_route(most: float):
    """Rows of a node with the nearest of its routing entries and the distance."""

    def assign(key: tuple[pa.Scalar, ...], rows: pa.Table, routes: pa.Table) -> pa.Table:
        if not rows.num_rows or not routes.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("x", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("node", pa.int64()), ("away", pa.float64()))})
        o = np.argsort(routes["child"].to_numpy())
        x, r = matrix(rows["x"].combine_chunks()), matrix(routes["route"].combine_chunks())[o]
        space = Space(np.concatenate((x, r)), most)
        near = space.to(np.arange(len(x)), np.arange(len(x), len(x) + len(r)))
        best = near.argmin(axis=1)
        child = routes["child"].to_numpy()[o]
        return pa.table({"x": rows["x"], "ids": rows["ids"], "node": pa.array(child[best]), "away": pa.array(near[np.arange(len(x)), best])})

    return assign


def _load_part(most: float):
    def load(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        x = matrix(rows["x"].combine_chunks())
        o = np.lexsort(x.T[::-1])  # the same tree, whatever the order of arrival
        x, ids = x[o], rows["ids"].take(pa.array(o)).to_pylist()
        out = []
        for number, p in enumerate(load_pages(x, most)):
            out.append({
                "node": key[0].as_py(), "deal": key[1].as_py(), "page": number, "leaf": p["leaf"], "centre": x[p["centre"]].tolist(), "vectors": x[p["rows"]].tobytes(),
                "ids": [ids[i] for i in p["rows"]] if p["leaf"] else [], "parent_distance": p["parent_distance"].tolist(), "radius": p["radius"].tolist(), "child": p["child"].tolist(),
            })
        return pa.Table.from_pylist(out, schema=_PAGES)

    return load


PAGES = "node long, deal long, page int, leaf boolean, centre array<long>, vectors binary, ids array<array<long>>, parent_distance array<double>, radius array<double>, child array<int>"
_PAGES = pa.schema([
    ("node", pa.int64()), ("deal", pa.int64()), ("page", pa.int32()), ("leaf", pa.bool_()), ("centre", pa.list_(pa.int64())), ("vectors", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64()))),
    ("parent_distance", pa.list_(pa.float64())), ("radius", pa.list_(pa.float64())), ("child", pa.list_(pa.int32())),
])


def _lift(v: str, most: float) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), F.lit(most) - _dot(v, v)))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def _between(a: str, b: str, most: float) -> Column:
    """Distance of two lifted vectors."""
    return F.sqrt(F.greatest(F.lit(0.0), 2 * F.lit(most) - 2 * _dot(a, b) - 2 * _lift(a, most) * _lift(b, most)))


def build(rows: DataFrame, k: int = TOP, part: int = PART, fanout: int = FANOUT) -> MTree | None:
    """The tree over ``rows (vec_id, x)``; its tables are written to the shared folder."""
    held = entries = written(entries_of(rows, k + 1).withColumn("node", F.lit(0).cast("bigint")), "tree-entries")
    n, most = entries.select(F.count(F.lit(1)), F.max(_dot("x", "x"))).first()
    if not n:
        return None
    root = entries.orderBy(F.xxhash64("x"), "x").first().x
    above = held.sparkSession.createDataFrame([(0, root)], "node long, centre array<long>")
    levels = []
    for _ in range(math.ceil(math.log(n / part, fanout)) if n > part else 0):
        size = held.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > part)
        big = held.join(size, "node").withColumn("salt", F.pmod(F.xxhash64(F.lit(3), "x"), F.ceil(F.col("size") / F.lit(10 * part))))
        first = Window.partitionBy("node").orderBy(F.xxhash64(F.lit(5), "node", "x"), "x")
        routes = big.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= fanout).select("node", (F.col("node") * (fanout + 1) + F.col("_r")).alias("child"), F.col("x").alias("route"))
        routes = written(routes, "tree-routes")
        salts = size.select("node", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("size") / F.lit(10 * part)) - 1)).alias("salt"))
        dealt = routes.join(salts, "node")
        moved = big.groupBy("node", "salt").cogroup(dealt.groupBy("node", "salt")).applyInArrow(_nearest_route(most), "x array<long>, ids array<long>, node long, away double")
        moved = written(moved, "tree-level")
        radius = moved.groupBy(F.col("node").alias("child")).agg(F.max("away").alias("radius"))
        level = routes.join(radius, "child").join(above, "node").select(F.col("node").alias("up"), "child", "route", "radius", _between("route", "centre", most).alias("parent_distance"))
        levels.append(written(level, "tree-upper"))
        small = held.join(size, "node", "left_anti").select("x", "ids", "node")
        held = moved.select("x", "ids", "node").unionByName(small)
        above = above.unionByName(levels[-1].select(F.col("child").alias("node"), F.col("route").alias("centre")))
    size = held.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
    dealt = held.join(size, "node").withColumn("deal", F.pmod(F.xxhash64(F.lit(7), "x"), F.ceil(F.col("size") / F.lit(2 * part))))
    pages = written(dealt.groupBy("node", "deal").applyInArrow(_load_part(most), PAGES), "tree-pages")
    tops = pages.where("page = 0").join(above.withColumnRenamed("centre", "_above"), "node")
    reach = F.array_max(F.zip_with("parent_distance", "radius", lambda d, r: d + r))
    parts = tops.select(F.col("node").alias("up"), F.struct("node", "deal").alias("part"), F.col("centre").alias("route"), reach.alias("radius"), _between("centre", "_above", most).alias("parent_distance"))
    levels.append(written(parts, "tree-parts"))
    return MTree(levels, pages, root, float(most))


def _reached(most: float):
    """Pairs of a query and a child with the distance, where it leaves the query within reach of the child."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            to = t["up"].is_valid().to_numpy(zero_copy_only=False) if t.num_rows else np.zeros(0, dtype=bool)
            d = t["d"].to_numpy().copy()
            if to.any():
                some = t.filter(pa.array(to))
                x, route = (matrix(some[c].combine_chunks(), np.float64) for c in ("x", "route"))
                d[to] = np.sqrt(np.maximum((x * x).sum(axis=1) + most - 2 * (x * route).sum(axis=1), 0))
            near = ~to | (d - np.where(to, t["radius"].to_numpy(), 0) <= t["reach"].to_numpy())
            t = t.set_column(t.column_names.index("d"), "d", pa.array(d)).drop_columns(["up", "route", "radius"])
            yield from t.filter(pa.array(near)).combine_chunks().to_batches()

    return run


def _asked(queries: DataFrame, tree: MTree) -> DataFrame:
    """Queries ``vec_id, x`` at the root, with their distance to its routing vector."""
    most = tree.most
    root = np.array(tree.root, dtype=float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1), np.float64)
            base = (x * x).sum(axis=1) + most
            d = np.sqrt(np.maximum(base - 2 * (x @ root), 0)) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_pydict({"vec_id": b.column(0), "x": b.column(1), "base": pa.array(base.ravel()[: len(b)]), "d": pa.array(d)})

    return queries.select("vec_id", "x").mapInArrow(run, "vec_id long, x array<long>, base double, d double").withColumn("node", F.lit(0).cast("bigint"))


def _descend(queries: DataFrame, tree: MTree, nearest: bool) -> DataFrame:
    """``vec_id, x, base, floor, part``: the nearest part of each query, or every part that may hold a product of at least ``floor``."""
    room = F.lit(SLACK) * (F.col("base") + tree.most)
    # the distance within which products reach the floor; sqrt(room) covers the rounding of small distances
    reach = F.sqrt(F.greatest(F.lit(0.0), F.col("base") - 2.0 * F.col("floor") + room)) + F.sqrt(room)
    at = queries.withColumn("reach", F.when(F.col("floor").isNull(), F.lit(float("inf"))).otherwise(reach))
    for level in tree.levels:
        last = "part" in level.columns
        child = "part" if last else "child"
        to = level.select("up", "route", "radius", "parent_distance", F.col(child).alias("_to"))
        far = F.abs(F.col("d") - F.col("parent_distance")) - F.col("radius")
        down = at.join(to, F.col("node") == F.col("up"), "left").where(F.col("up").isNull() | (far <= F.col("reach")))
        down = down.withColumn("to", F.col("_to") if last else F.coalesce("_to", "node")).select("vec_id", "x", "base", "floor", "reach", "d", "to", "up", "route", "radius")
        kept = [f for f in down.schema.fields if f.name not in ("up", "route", "radius")]
        at = down.mapInArrow(_reached(tree.most), StructType(kept)).withColumnRenamed("to", "part" if last else "node")
        if nearest:
            at = at.groupBy("vec_id", "x").agg(F.min(F.struct("d", *(c for c in at.columns if c not in ("vec_id", "x", "d")))).alias("s")).select("vec_id", "x", "s.*")
    return at.select("vec_id", "x", "base", "floor", "part")


FOUND = "vec_id long, x array<long>, score long, other long"


def _search_parts(asked: DataFrame, tree: MTree, k: int, block: int) -> DataFrame:
    """The best of each query in each part asked that reach its floor."""
    most = tree.most

    def search(key: tuple[pa.Scalar, ...], queries: pa.Table, pages: pa.Table) -> pa.Table:
        at, found = [], []
        if queries.num_rows and pages.num_rows:
            asked = matrix(queries["x"].combine_chunks())
            loaded, rows, ids, total = [], [], [], 0
            for p in sorted(pages.to_pylist(), key=lambda p: p["page"]):
                x = np.frombuffer(p["vectors"], dtype=np.int64).reshape(len(p["child"]), asked.shape[1])
                own = {c: np.array(p[c]) for c in ("parent_distance", "radius", "child")}
                loaded.append({"leaf": p["leaf"], "rows": total + np.arange(len(x)), "centre": p["centre"], **own})
                rows.append(x)
                ids += p["ids"] or [[]] * len(x)
                total += len(x)
            part = PartTree(np.concatenate(rows), ids, most, loaded)
            for i, (vec_id, floor) in enumerate(zip(queries["vec_id"].to_pylist(), queries["floor"].to_pylist())):
                best, _ = part.search(asked[i], vec_id, k, floor)
                at += [i] * len(best)
                found += best
        at = pa.array(at, pa.int64())
        kinds = (("score", [f[0] for f in found]), ("other", [f[1] for f in found]))
        out = {"vec_id": queries["vec_id"].take(at), "x": queries["x"].take(at)} if queries.num_rows else {"vec_id": pa.array([], pa.int64()), "x": pa.array([], pa.list_(pa.int64()))}
        return pa.table(out | {c: pa.array(v, pa.int64()) for c, v in kinds})

    blocks = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    queries = asked.join(blocks, "part").withColumn("block", F.pmod(F.xxhash64("vec_id", "x"), F.col("blocks")))
    here = tree.pages.withColumn("part", F.struct("node", "deal")).drop("node", "deal").join(blocks, "part")
    here = here.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    keys = (F.col("part.node").alias("node"), F.col("part.deal").alias("deal"), "block")
    left = queries.select(*keys, "vec_id", "x", "floor").groupBy("node", "deal", "block")
    right = here.select(*keys, "page", "leaf", "centre", "vectors", "ids", "parent_distance", "radius", "child").groupBy("node", "deal", "block")
    return left.cogroup(right).applyInArrow(search, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("vec_id", "x").orderBy(F.desc("score"), F.col("other").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(embeddings: DataFrame, k: int = TOP, step: int = STEP, part: int = PART, fanout: int = FANOUT, block: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest products of each query row (ids divisible by ``step``)."""
    rows = written(usable(embeddings, FACTOR, limit=LIMIT), "tree-rows")
    tree = build(rows, k, part, fanout)
    if tree is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    queries = rows.where(F.col("vec_id") % step == 0).groupBy("vec_id", "x").agg(F.count(F.lit(1)).alias("copies"))
    queries = written(queries, "tree-queries")
    asked = written(_asked(queries, tree).withColumn("floor", F.lit(None).cast("bigint")), "tree-asked")
    home = written(_descend(asked, tree, nearest=True), "tree-home")
    first = written(_search_parts(home, tree, k, block), "tree-first")
    floors = first.groupBy("vec_id", "x").agg(F.when(F.count("score") >= k, F.min("score")).alias("floor"))
    rest = _descend(asked.drop("floor").join(floors, ["vec_id", "x"]), tree, nearest=False)
    rest = written(rest.join(home, ["vec_id", "x", "part"], "left_anti"), "tree-rest")
    found = _best(first.unionByName(_search_parts(rest, tree, k, block)), k).join(queries, ["vec_id", "x"])
    return found.select(F.col("vec_id").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("other").alias("vec_id"), "score", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy")).drop("_copy")
