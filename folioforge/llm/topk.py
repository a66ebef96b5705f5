"""Exact top-k search by inner product through a pivot-distance index.

Every vector x is keyed by its nearest pivot and its distance d from it;
distances are cut into annuli, and an annulus of a pivot is a cell. A query q at
distance D from that pivot is at least |D - d| away from x, so that

    q . x = (|q|^2 + |x|^2 - |q - x|^2) / 2 <= (|q|^2 + |x|^2 - (D - d)^2) / 2.

A query first reads the cells with the largest bounds, which gives the k-th best
score so far, and then only the cells, and in them only the part of the sorted
distances, that this score does not rule out. Lengths are those of the vectors
themselves (of the longest one of a cell), so vectors of any lengths share an
index without being stretched to one length.

The number of pivots follows the number of vectors. What moves between tasks is
larger than a cell: cells of neighbouring pivots form a region of bounded size,
and queries of neighbouring pivots form slabs. A group is one region and one
slab; its cells are read as matrix products. Only the rows of cells that a slab
asks for move to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.llm.common import materialize, ship

#: Vectors on which pivots and annuli are fitted, at most; all vectors are indexed.
SAMPLE = 4096
#: Annuli of a pivot; pivots for n vectors of a dimension are sqrt(n), at most MOST_PIVOTS.
ANNULI = 4
MOST_PIVOTS = 1024
#: Components of the vectors of a region, and of the queries of a slab: what a task holds at a time.
REGION_VALUES = 1 << 20
SLAB_VALUES = 1 << 19
#: Queries that share a matrix product.
TOGETHER = 64
#: Below this squared length, inner products of whole numbers are exact in doubles.
EXACT = float(2**52)


def quantize(embedding: Column) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & ~bad, F.lit(False))


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * (x @ points.T), 0))


def pivots_for(n: int) -> int:
    return max(1, min(MOST_PIVOTS, round(sqrt(n))))


class Pivots:
    """Pivots and annulus edges of the vectors of each dimension; neighbouring numbers are near each other."""

    def __init__(self, sample: dict[int, np.ndarray], sizes: dict[int, int]):
        self.points: dict[int, np.ndarray] = {}
        self.edges: dict[int, np.ndarray] = {}
        for dim, rows in sample.items():
            x = rows.astype(np.float64)
            r = np.random.default_rng(7)
            points = x[r.choice(len(x), min(pivots_for(sizes.get(dim, len(x))), len(x)), replace=False)]
            for _ in range(6):
                near = distances(x, points).argmin(axis=1)
                points = np.stack([x[near == k].mean(axis=0) if (near == k).any() else points[k] for k in range(len(points))])
            points = self._chained(points)
            d = distances(x, points)
            near, d = d.argmin(axis=1), d.min(axis=1)
            self.points[dim] = points
            self.edges[dim] = np.stack([np.quantile(d[near == k] if (near == k).any() else [0.0], np.arange(1, ANNULI) / ANNULI) for k in range(len(points))])

    @staticmethod
    def _chained(points: np.ndarray) -> np.ndarray:
        """Each point followed by the nearest of those left."""
        d = distances(points, points)
        order, left = [0], set(range(1, len(points)))
        while left:
            order.append(min(left, key=lambda k: (d[order[-1], k], k)))
            left.remove(order[-1])
        return points[order]

    def of(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """A dimension that the sample lacks has the origin as its pivot."""
        return self.points.get(dim, np.zeros((1, dim))), self.edges.get(dim, np.zeros((1, 0)))

    def key(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pivot, annulus, distance) of each row."""
        points, edges = self.of(rows.shape[1])
        d = distances(rows.astype(np.float64), points)
        near, d = d.argmin(axis=1), d.min(axis=1)
        return near, (d[:, None] > edges[near]).sum(axis=1), d


def _by_dim(values: list[bytes], dtype: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, positions, rows) of packed vectors."""
    width = np.dtype(dtype).itemsize
    lengths = np.array([len(v) // width for v in values])
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield int(dim), at, np.frombuffer(b"".join(values[k] for k in at), dtype).reshape(len(at), dim)


def build_index(vectors: DataFrame) -> tuple[DataFrame, Pivots, str]:
    """(row, vec_id, dim, pivot, annulus, dist, norm2, vec) of every usable vector; the pivots; how ``vec`` is packed."""
    ship(vectors.sparkSession)
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), quantize(F.col("embedding")).alias("q"))
    norm = F.aggregate("q", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    # One row for each dimension there is.
    shape = {r["dim"]: r for r in rows.groupBy(F.size("q").alias("dim")).agg(F.max(norm).alias("longest"), F.count(F.lit(1)).alias("n")).collect()}
    dtype = "<i2" if max((r["longest"] or 0.0 for r in shape.values()), default=0.0) <= 32767.0**2 else "<i8"
    sample: dict[int, list] = {}
    for row in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("q").collect():
        sample.setdefault(len(row["q"]), []).append(row["q"])
    pivots = Pivots({dim: np.array(x, np.int64).reshape(len(x), dim) for dim, x in sample.items()}, {dim: r["n"] for dim, r in shape.items()})
    schema = "vec_id long, dim int, pivot int, annulus int, dist double, norm2 double, vec binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = [np.array(v.as_py(), np.int64).astype(dtype).tobytes() for v in batch.column(1)]
            n = batch.num_rows
            dims, near, ring, dist, norm2 = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n)
            for dim, at, x in _by_dim(packed, dtype):
                dims[at], norm2[at] = dim, (x.astype(np.float64) ** 2).sum(axis=1)
                near[at], ring[at], dist[at] = pivots.key(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims), pa.array(near), pa.array(ring), pa.array(dist), pa.array(norm2), pa.array(packed, pa.binary())], names=["vec_id", "dim", "pivot", "annulus", "dist", "norm2", "vec"])

    # The row number is written, and so fixed, before anything is dealt by it.
    return materialize(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "vectors"), pivots, dtype


@dataclass
class Cells:
    """The cells of a dimension, in order of their pivots; ``first_region`` and ``regions`` say where each one's rows are."""

    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    norm2: np.ndarray
    n: np.ndarray
    first_region: np.ndarray
    regions: np.ndarray

    def bounds(self, q2: np.ndarray, far: np.ndarray) -> np.ndarray:
        """(queries, cells): no row of the cell has a larger product with the query; ``far`` has distances of queries from pivots.

        A little is added for rounding.
        """
        d = far[:, self.pivot]
        gap = np.maximum(0, np.maximum(d - self.high, self.low - d))
        most = q2[:, None] + self.norm2
        return (most - gap * gap) / 2 + 1e-9 * most + 1e-6


def lay_out(stats: list, sizes: dict[int, int]) -> tuple[dict[int, Cells], list[tuple[int, int, int, int, int, int, int]]]:
    """The cells of each dimension, and (dim, pivot, annulus, cell, first region, regions, slabs) of each.

    ``sizes`` counts queries. Cells fill a region up to its size, one after the
    other; a larger cell has regions of its own, to which its rows are dealt.
    """
    by_dim: dict[int, list] = {}
    for c in stats:
        by_dim.setdefault(c["dim"], []).append(c)
    cells, rows, region = {}, [], -1
    for dim, found in sorted(by_dim.items()):
        found.sort(key=lambda c: (c["pivot"], c["annulus"]))
        room_of = max(1, REGION_VALUES // max(1, dim))
        slabs = max(1, ceil(sizes.get(dim, 0) / max(1, SLAB_VALUES // max(1, dim))))
        room, first, many = 0, [], []
        for c in found:
            if c["n"] > room_of:
                first.append(region + 1)
                many.append(ceil(c["n"] / room_of))
                region, room = region + many[-1], 0
            else:
                if c["n"] > room:
                    region, room = region + 1, room_of
                first.append(region)
                many.append(1)
                room -= c["n"]
        column = lambda k: np.array([c[k] for c in found])  # noqa: B023, E731
        cells[dim] = Cells(column("pivot"), column("low"), column("high"), column("norm2"), column("n"), np.array(first), np.array(many))
        rows += [(dim, c["pivot"], c["annulus"], k, first[k], many[k], slabs) for k, c in enumerate(found)]
    return cells, rows


VISITS = "query_id long, query binary, bound double, slab int, region int, cells array<int>"
HITS = "query_id long, query binary, vec_id long, score long, scored long"


def first_rows(n: int, k: int) -> int:
    """Rows that the cells of a query's first round hold at least, of n."""
    return max(k + 1, ceil(4 * sqrt(n)))


def _visits(queries: DataFrame, pivots: Pivots, cells: dict[int, Cells], dtype: str, k: int, first: bool) -> DataFrame:
    """Regions, and cells in them, that each (query_id, query, bound, slab) has to read in this round.

    The first round takes the cells with the largest bounds until they hold
    enough rows; the second takes, of the others, those that may hold a score of
    ``bound`` or more (null: all).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids, packed, bounds, slabs = (c.to_pylist() for c in part.columns)
                out: list[tuple] = []
                for dim, at, x in _by_dim(packed, dtype):
                    c, x = cells[dim], x.astype(np.float64)
                    most = c.bounds((x * x).sum(axis=1), distances(x, pivots.of(dim)[0]))
                    enough = first_rows(int(c.n.sum()), k)
                    for i, ub in zip(at, most, strict=True):
                        order = np.argsort(-ub, kind="stable")
                        begun = int(np.searchsorted(np.cumsum(c.n[order]), enough)) + 1
                        order = order[:begun] if first else order[begun:]
                        if not first and bounds[i] is not None:
                            order = order[ub[order] >= bounds[i]]
                        wanted: dict[int, list[int]] = {}
                        for cell in order.tolist():
                            for region in range(c.first_region[cell], c.first_region[cell] + c.regions[cell]):
                                wanted.setdefault(region, []).append(cell)
                        out += [(ids[i], packed[i], bounds[i], slabs[i], region, found) for region, found in wanted.items()]
                if out:
                    kinds = (pa.int64(), pa.binary(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["query_id", "query", "bound", "slab", "region", "cells"])

    return queries.select("query_id", "query", "bound", "slab").mapInArrow(run, VISITS)


def _best(who: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each ``who``, in order; ties go to the smaller id."""
    order = np.lexsort((ids, -score, who))
    who, ids, score = who[order], ids[order], score[order]
    keep = np.arange(len(who)) - np.searchsorted(who, who) < k
    return who[keep], ids[keep], score[keep]


def read_region(held: pa.Table, asked: pa.Table, pivots: Pivots, dtype: str, exact: bool, k: int) -> pa.Table:
    """The best k of a region for each of its visitors, and how many rows were scored for it."""
    names = ["query_id", "query", "vec_id", "score", "scored"]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    query_ids, packed = asked["query_id"].to_numpy(), asked["query"].to_pylist()
    scored = np.zeros(len(packed), np.int64)
    if held.num_rows and len(packed):
        kind = np.float64 if exact else np.int64
        cell, dist = held["cell"].to_numpy(), held["dist"].to_numpy()
        order = np.lexsort((dist, cell))
        cell, dist, ids, norm2 = cell[order], dist[order], held["vec_id"].to_numpy()[order], held["norm2"].to_numpy()[order]
        x = np.frombuffer(b"".join(held["vec"].to_pylist()), dtype).reshape(len(order), -1)[order].astype(kind)
        pivot = held["pivot"].to_numpy()[order]
        q = np.frombuffer(b"".join(packed), dtype).reshape(len(packed), -1).astype(kind)
        q2, far = (q.astype(np.float64) ** 2).sum(axis=1), distances(q.astype(np.float64), pivots.of(x.shape[1])[0])
        bound = np.array([-np.inf if b is None else b for b in asked["bound"].to_pylist()])
        # Which queries ask for which cell, cell after cell.
        lists = asked["cells"].to_pylist()
        who, what = np.repeat(np.arange(len(lists)), [len(c) for c in lists]), np.array([c for found_cells in lists for c in found_cells], np.int64)
        by_cell = np.argsort(what, kind="stable")
        who, what = who[by_cell], what[by_cell]
        for c in np.unique(what):
            a, b = np.searchsorted(cell, (c, c + 1))
            if a == b:
                continue
            visitors = who[np.searchsorted(what, c) : np.searchsorted(what, c + 1)]
            d = far[visitors, pivot[a]]
            most = q2[visitors] + norm2[a:b].max()
            reach = np.sqrt(np.maximum(most - 2 * bound[visitors], 0) + 1e-8 * most + 1e-5)
            near_first = np.argsort(d, kind="stable")
            for start in range(0, len(near_first), TOGETHER):
                some = near_first[start : start + TOGETHER]
                lo = a + np.searchsorted(dist[a:b], d[some] - reach[some], "left")
                hi = a + np.searchsorted(dist[a:b], d[some] + reach[some], "right")
                lo, hi = int(lo.min()), int(hi.max())
                if lo >= hi:
                    continue
                v = visitors[some]
                scored[v] += hi - lo
                score = q[v] @ x[lo:hi].T
                good = (score >= bound[v][:, None]) & (query_ids[v][:, None] != ids[lo:hi])
                if hi - lo > k:
                    # Nothing below a query's k-th best here can count.
                    shown = np.where(good, score, np.iinfo(np.int64).min if kind is np.int64 else -np.inf)
                    good &= shown >= np.partition(shown, hi - lo - k, axis=1)[:, hi - lo - k][:, None]
                i, j = np.nonzero(good)
                i, near, got = _best(i, ids[lo + j], score[i, j], k)
                found.append((v[i], near, got.astype(np.int64)))
                full, at = np.unique(i, return_index=True)
                last = at + k - 1
                held_k = (last < len(i)) & (i[np.minimum(last, len(i) - 1)] == full) if len(i) else np.empty(0, bool)
                bound[v[full[held_k]]] = np.maximum(bound[v[full[held_k]]], got[last[held_k]])
    if found:
        who, ids, score = _best(*(np.concatenate(c) for c in zip(*found, strict=True)), k)
    else:
        who = ids = score = np.empty(0, np.int64)
    # A visitor without hits keeps a row without vector, for what was scored.
    none = np.setdiff1d(np.arange(len(packed)), who)
    first = np.concatenate([np.ones(min(1, len(who)), bool), who[1:] != who[:-1]]) if len(who) else np.empty(0, bool)
    rows = np.concatenate([who, none]).astype(np.int64)
    columns = (
        pa.array(query_ids[rows], pa.int64()),
        pa.array([packed[r] for r in rows], pa.binary()),
        pa.array([*ids.tolist(), *[None] * len(none)], pa.int64()),
        pa.array([*score.tolist(), *[None] * len(none)], pa.int64()),
        pa.array(np.concatenate([np.where(first, scored[who], 0), scored[none]]).astype(np.int64)),
    )
    return pa.table(list(columns), names=names)


def asked_for(index: DataFrame, visits: DataFrame) -> DataFrame:
    """Rows of the index, once for each slab that has a visit to their cell; the others don't move.

    A cell has at most the rows of a region in each region, so no key of the join is large.
    """
    slabs = visits.select("region", "slab", F.explode("cells").alias("cell")).groupBy("region", "cell").agg(F.collect_set("slab").alias("slabs"))
    return index.join(slabs, ["region", "cell"]).select(*index.columns, F.explode("slabs").alias("slab"))


def _read(index: DataFrame, visits: DataFrame, pivots: Pivots, dtype: str, exact: bool, k: int) -> DataFrame:
    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        return read_region(held, asked, pivots, dtype, exact, k)

    return index.groupBy("region", "slab").cogroup(visits.groupBy("region", "slab")).applyInArrow(run, HITS)


def top_k(vectors: DataFrame, is_query: Column | None = None, k: int = 5, with_cost: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query with the rows of other ids.

    ``vectors`` has vec_id and embedding; components x count as floor(256 * x);
    other columns, whatever their names, are not read. Queries are the rows of
    ``is_query`` (default: ids divisible by 50). Ties go to the smaller vec_id.
    Rows whose vector is null or holds null or a non-finite component, and rows
    without id, take no part; vectors are compared with those of the same
    dimension, however long; empty vectors score 0. A repeated query row gives
    one answer; a repeated candidate counts as often as it is there. With fewer
    than k candidates all are returned; an empty table has no answers.
    ``with_cost`` adds ``n_scored``, the rows that were scored for the query.
    """
    is_query = F.col("vec_id") % 50 == 0 if is_query is None else is_query
    spark = vectors.sparkSession
    index, pivots, dtype = build_index(vectors)
    # At most MOST_PIVOTS * ANNULI cells for each dimension.
    stats = [c.asDict() for c in index.groupBy("dim", "pivot", "annulus").agg(F.min("dist").alias("low"), F.max("dist").alias("high"), F.max("norm2").alias("norm2"), F.count(F.lit(1)).alias("n")).collect()]
    exact = max((c["norm2"] for c in stats), default=0.0) < EXACT
    # A repeated query row counts once, even if rounding gave its rows different pivots.
    queries = materialize(index.where(is_query).groupBy(F.col("vec_id").alias("query_id"), F.col("vec").alias("query"), "dim").agg(F.min("pivot").alias("pivot")), "queries")
    # At most MOST_PIVOTS rows for each dimension.
    asking = sorted((r["dim"], r["pivot"], r["n"]) for r in queries.groupBy("dim", "pivot").agg(F.count(F.lit(1)).alias("n")).collect())
    sizes: dict[int, int] = {}
    before = []
    for dim, pivot, n in asking:
        before.append((dim, pivot, sizes.get(dim, 0), n))
        sizes[dim] = sizes.get(dim, 0) + n
    cells, rows = lay_out(stats, sizes)
    places = spark.createDataFrame(rows, "dim int, pivot int, annulus int, cell int, first_region int, regions int, slabs int")
    slabs = {r[0]: r[6] for r in rows}
    slabs_of = spark.createDataFrame([(*r, slabs[r[0]], sizes[r[0]]) for r in before], "dim int, pivot int, before long, n long, slabs int, size long")
    dealt = index.join(F.broadcast(places), ["dim", "pivot", "annulus"])
    dealt = dealt.select("vec_id", "vec", "dist", "norm2", "pivot", "cell", (F.col("first_region") + F.pmod(F.xxhash64("row"), "regions")).cast("int").alias("region"))
    queries = _with_slab(queries, slabs_of).select("query_id", "query", "slab")

    def visit(asked: DataFrame, first: bool) -> DataFrame:
        # Written, as they are read twice: to find which rows are asked for, and with them.
        visits = materialize(_visits(asked, pivots, cells, dtype, k, first), "visits")
        return _read(asked_for(dealt, visits), visits, pivots, dtype, exact, k)

    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    hits = materialize(visit(queries.withColumn("bound", F.lit(None).cast("double")), True), "hits")
    bounds = hits.where("vec_id IS NOT NULL").withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", "query", F.col("score").cast("double").alias("bound"))
    bounded = materialize(queries.join(bounds, ["query_id", "query"], "left"), "bounds")
    both = hits.unionByName(visit(bounded, False))
    ranked = both.where("vec_id IS NOT NULL").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    if not with_cost:
        return ranked.select("query_id", "rank", "vec_id", "score")
    cost = both.groupBy("query_id", "query").agg(F.sum("scored").alias("n_scored"))
    return ranked.join(cost, ["query_id", "query"]).select("query_id", "rank", "vec_id", "score", "n_scored")


def _with_slab(queries: DataFrame, slabs_of: DataFrame) -> DataFrame:
    """Queries in order of their pivots fill one slab after the other, so that those of a slab ask for the same cells; those of one pivot are dealt by a hash."""
    share = F.pmod(F.xxhash64("query_id", "query"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    slab = F.floor((F.col("before") + share * F.col("n")) * F.col("slabs") / F.col("size"))
    return queries.join(F.broadcast(slabs_of), ["dim", "pivot"]).withColumn("slab", F.least(slab, F.col("slabs") - 1).cast("int"))
