import math

import numpy as np
import pytest

from folioforge.llm import topk as K


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in {(i, tuple(v)) for i, v in ok if i % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in ok if i != q and len(v) == len(x))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=5):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("dist", F.lit("clash")).withColumn("block", F.lit(0)).repartition(3)
    return sorted(tuple(r) for r in K.top_k(df, k=k).collect())


def clustered(n, dim, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, dim))
    return [(i, (centres[i % 8] * r.uniform(0.3, 2) + r.normal(size=dim) * 0.2).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize(("region_values", "slab_values"), [(K.REGION_VALUES, K.SLAB_VALUES), (480, 60)])
def test_against_brute_force(spark, monkeypatch, region_values, slab_values):
    monkeypatch.setattr(K, "REGION_VALUES", region_values)
    monkeypatch.setattr(K, "SLAB_VALUES", slab_values)
    rows = clustered(900, 12)
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2050, [None] + [1.0] * 11), (2100, [float("nan")] * 12), (2150, [float("inf")] * 12), (None, rows[0][1])]
    assert run(spark, rows) == brute(rows)


def test_other_dimensions_and_few_candidates(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, -1.0]), (50, [0.5] * 3), (51, [1.0] * 3), (52, [-1.0] * 3), (100, []), (101, []), (150, [1.0])]
    assert run(spark, rows) == brute(rows)


def test_repeated_rows(spark):
    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0])]
    assert run(spark, rows) == brute(rows)


def test_large_components(spark):
    rows = [(i, [float(1000 * i), -3.0]) for i in range(0, 120, 5)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_no_row_beats_the_bound_of_its_cell(seed):
    r = np.random.default_rng(seed)
    rows = (r.normal(size=(400, 6)) * r.uniform(1, 300, size=(400, 1))).astype(np.int64)
    p = K.Pivots({6: rows}, {6: 400})
    pivot, ring, dist = p.key(rows)
    norm2 = (rows.astype(float) ** 2).sum(axis=1)
    keys = sorted(set(zip(pivot.tolist(), ring.tolist(), strict=True)))
    inside = [(pivot == a) & (ring == b) for a, b in keys]
    stats = [{"dim": 6, "pivot": a, "annulus": b, "low": dist[m].min(), "high": dist[m].max(), "norm2": norm2[m].max(), "n": int(m.sum())} for (a, b), m in zip(keys, inside, strict=True)]
    cells, _ = K.lay_out(stats, {6: 8})
    q = rows[:40].astype(float)
    bounds = cells[6].bounds((q * q).sum(axis=1), K.distances(q, p.points[6]))
    best = np.stack([(q @ rows[m].T).max(axis=1) for m in inside], axis=1)
    assert (bounds >= best).all()
    assert np.median(bounds - best) < norm2.max()


def test_most_rows_of_clustered_vectors_are_never_scored(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + r.normal(size=16) * 0.05).astype(np.float32).tolist()) for i in range(4000)]
    got = K.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), with_cost=True).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute(rows)
    assert np.mean([r["n_scored"] for r in got]) < 0.25 * len(rows)


def test_a_hot_cell_and_its_queries_are_split(spark, monkeypatch):
    """A third of all vectors are equal, and many of them are queries."""
    monkeypatch.setattr(K, "REGION_VALUES", 64)
    monkeypatch.setattr(K, "SLAB_VALUES", 8)
    rows = [(i, [1.0, 2.0] if i % 3 == 0 else [float(i % 7), -1.0]) for i in range(0, 3000, 10)]
    assert run(spark, rows) == brute(rows)
    stats = [{"dim": 2, "pivot": 0, "annulus": 0, "low": 0.0, "high": 0.0, "norm2": 5.0, "n": 100}, {"dim": 2, "pivot": 1, "annulus": 0, "low": 0.0, "high": 1.0, "norm2": 5.0, "n": 20}, {"dim": 2, "pivot": 2, "annulus": 0, "low": 0.0, "high": 1.0, "norm2": 5.0, "n": 12}]
    cells, places = K.lay_out(stats, {2: 9})
    assert cells[2].regions.tolist() == [4, 1, 1] and cells[2].first_region.tolist() == [0, 4, 4]
    assert {p[6] for p in places} == {3}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_only_rows_that_are_asked_for_move(spark, monkeypatch):
    """Index rows that reach a slab are those of the cells that its queries visit, and no more; queries of a slab are near each other."""
    monkeypatch.setattr(K, "SLAB_VALUES", 16 * 8)
    monkeypatch.setattr(K, "REGION_VALUES", 16 * 200)
    r = np.random.default_rng(5)
    centres = r.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + r.normal(size=16) * 0.05).astype(np.float32).tolist()) for i in range(4000)]
    moved = []
    asked_for = K.asked_for

    def counted(index, visits):
        out = asked_for(index, visits)
        wanted = {(v["region"], c, v["slab"]) for v in visits.collect() for c in v["cells"]}
        held = {}
        for x in index.collect():
            held[x["region"], x["cell"]] = held.get((x["region"], x["cell"]), 0) + 1
        slabs = {v["slab"] for v in visits.collect()}
        n = out.count()
        assert n == sum(held[a, b] for a, b, _ in wanted)
        moved.append((n, len(slabs)))
        return out

    monkeypatch.setattr(K, "asked_for", counted)
    assert run(spark, rows) == brute(rows)
    assert max(s for _, s in moved) == 10
    # Not 4000 rows for each of the slabs.
    assert all(n <= 0.1 * 4000 * s for n, s in moved), moved
