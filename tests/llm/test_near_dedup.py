import pytest

from folioforge.llm import near_dedup as N
from folioforge.llm.graph import components
from helpers import documents, long_text, near_components, near_copies


def run(spark, rows, near):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_dedup(documents(spark, rows, extra=True), near).collect()}


@pytest.mark.parametrize("near", [N.Near(3, 85), N.Near()])
def test_components_as_by_all_pairs(spark, near):
    rows = near_copies() + [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "ONE"), (905, "One two"), (906, "É x y z"), (907, "é x y z"), (908, long_text()), (909, long_text() + " end")]
    want = near_components(rows, near.words, near.percent)
    assert run(spark, rows, near) == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "x y z"), (2, "A B C D")]
    got = sorted((tuple(r) for r in N.near_dedup(documents(spark, rows), N.Near(3, 85)).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 1, None, True), (2, 2, 1, False)], key=repr)


def test_empty_table(spark):
    assert N.near_dedup(documents(spark, [])).collect() == []


def test_pruning_never_loses_a_pair_at_the_threshold_often():
    near = N.Near(3, 85)
    least = near.least_matches()
    assert len(least) == N.LANES // N.BATCH and least == sorted(least)
    assert least[-1] < 0.85 * N.LANES
    assert (1 - 0.85**near.rows) ** (N.LANES // near.rows) <= near.miss


def test_chains_of_links(spark):
    """Similarity is not transitive, components are."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 100])) for i in range(40)]
    near = N.Near(3, 85)
    want = near_components(rows, 3, 85)
    assert run(spark, rows, near) == {i: (n, c, i == c) for i, (n, c) in want.items()}
    assert {c for _, c in want.values()} == {0}


def test_graph(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def around_a_passage(n, own, shared, seed=8):
    """Texts that share a passage, and are not similar."""
    import random

    r = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(shared))
    return [(i, passage + " " + " ".join(f"o{r.randrange(10**9)}" for _ in range(own))) for i in range(n)]


def near_families(seed=9, families=6, members=25, words=150):
    """Families of copies whose members have much, and often enough, in common with those of other families."""
    import random

    r = random.Random(seed)
    base, rows = [f"b{i}" for i in range(words)], []
    for f in range(families):
        own = list(base)
        for k in r.sample(range(words), 3):
            own[k] = f"f{f}x{k}"
        for m in range(members):
            text = list(own)
            for k in r.sample(range(words), r.randint(0, 5)):
                text[k] = f"m{f}x{m}x{k}"
            rows.append((1000 * f + m, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [N.BLOCK, 8])
def test_several_blocks_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "GROUP_ROWS", 4 * block)
    monkeypatch.setattr(N, "SET_BYTES", 1000 * block)
    monkeypatch.setattr(N, "PAIRS", 50 * block)
    near = N.Near(3, 85)
    rows = near_families() + [(100_000 + i, t) for i, t in around_a_passage(60, 30, 100)]
    want = near_components(rows, 3, 85)
    assert len({c for _, c in want.values()}) > 70
    assert run(spark, rows, near) == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_similar_members_are_tied_and_met(spark):
    """Whatever components they are in, all pairs that reach the threshold are in one cluster, and survive in one bucket."""
    from pyspark.sql import functions as F

    from helpers import shingles

    near = N.Near(3, 85)
    rows = near_families(families=4, members=12) + [(100_000 + i, t) for i, t in around_a_passage(20, 30, 100)]
    docs = documents(spark, rows)
    found = N.materialize(N.features(docs, near).withColumn("id", F.col("doc_id")), "found")
    sets = N.full_sets(docs, found.select("id", "digest"), near)
    cluster = {r["id"]: r["cluster"] for r in N.tied_members(N.rare_shingles(found.select("id", F.col("id").alias("comp")), sets, near)).collect()}
    held = {i: shingles(t, 3) for i, t in rows}
    similar = {(a, b) for a in held for b in held if a < b and 100 * len(held[a] & held[b]) >= 85 * len(held[a] | held[b])}
    assert similar and all(cluster[a] == cluster[b] for a, b in similar)
    assert not any(i >= 100_000 for i in cluster)
    everyone = found.select(F.explode("bands").alias("key"), F.lit(0).cast("long").alias("cluster"), "id", F.col("id").alias("comp"))
    table = N.deal(everyone, found.select("id", "lanes", "bands")).toArrow()
    ids = table["id"].to_pylist()
    met = [tuple(sorted((ids[p], ids[q]))) for x, y, _ in N.near_pairs(table, near.least_matches()) for p, q in zip(x, y, strict=True)]
    assert len(met) == len(set(met)) and similar <= set(met)
    pairs = spark.createDataFrame(sorted(met), "a long, b long")
    assert {tuple(r) for r in N.verify(pairs, sets, near).collect()} == similar


@pytest.mark.parametrize("n", [40, 160])
def test_texts_around_one_passage_do_not_meet(spark, n):
    near = N.Near(3, 85)
    docs = documents(spark, around_a_passage(n, 30, 100))
    ids = N.features(docs, near).select(N.F.col("doc_id").alias("id"), "digest")
    rare = N.rare_shingles(ids.select("id", N.F.col("id").alias("comp")), N.full_sets(docs, ids, near), near)
    assert rare.count() == 0
