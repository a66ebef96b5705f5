import hashlib
from collections import Counter
from math import exp, sqrt

import pytest

from folioforge.llm import mixing
from helpers import documents, long_text


def unit(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52


def poisson(u, mean):
    k, p = 0, exp(-mean)
    total = p
    while total <= u and k < mean + 12 * sqrt(mean) + 20:
        k += 1
        p *= mean / k
        total += p
    return k


def brute(rows, weight, total=None):
    counts = Counter(r[3] for r in rows)
    weights = {s: weight(s, n) for s, n in counts.items()}
    rate = {s: round(weights[s] / sum(weights.values()) * (total or len(rows)) / n, 9) for s, n in counts.items()}
    out = Counter()
    for i, _, _, s in rows:
        n = poisson(unit("mix", "null" if i is None else i), rate[s])
        for c in range(1, n + 1):
            out[i, s, c] += 1
    return out


ROWS = [(i, f"text {i}", "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(900)] + [(1000, None, "en", None), (1001, "", "en", None), (1002, long_text(), "en", "s1"), (5, "text 5", "en", "s5"), (None, "x", "en", "s2")]


@pytest.mark.parametrize("options, weight", [({}, lambda s, n: sqrt(n)), ({"target_weights": {"hot": 3.0, "s1": 1.0, None: 2.0}, "total": 1500.0}, lambda s, n: {"hot": 3.0, "s1": 1.0, None: 2.0}.get(s, 0.0))])
def test_counts_as_by_inversion(spark, options, weight):
    out = mixing.mix_sources(documents(spark, ROWS, extra=True), **options).collect()
    assert Counter((r["doc_id"], r["source"], r["mix_copy"]) for r in out) == brute(ROWS, weight, options.get("total"))
    text = {(r[0], r[3]): r[1] for r in ROWS}
    assert all(r["text"] == text[r["doc_id"], r["source"]] for r in out)


def test_any_partitioning_gives_the_same_copies_and_seeds_differ(spark):
    docs = documents(spark, ROWS)
    count = lambda d, **k: Counter((r["doc_id"], r["mix_copy"], r["mix_key"]) for r in mixing.mix_sources(d, **k).collect())
    assert count(docs) == count(docs.repartition(7)) != count(docs, seed="other")


def test_large_means_and_order(spark):
    docs = documents(spark, [(i, "t", "en", "s") for i in range(20)])
    out = mixing.mix_sources(docs, {"s": 1.0}, total=20 * 1500.0)
    n = Counter(r["doc_id"] for r in out.collect())
    assert all(1300 < n[i] < 1700 for i in range(20))
    assert len({i for i, in out.select("doc_id").take(50)}) > 10


def test_mean_is_the_rate(spark):
    docs = documents(spark, [(i, "t", "en", "s") for i in range(5000)])
    assert abs(mixing.mix_sources(docs, {"s": 1.0}, total=6000.0).count() - 6000) < 5 * sqrt(6000)


def test_nothing_weighs_anything(spark):
    assert mixing.mix_sources(documents(spark, ROWS), {"absent": 1.0}).count() == 0
    assert mixing.mix_sources(documents(spark, [])).count() == 0


def test_columns_with_the_operators_names(spark):
    from pyspark.sql import functions as F

    names = ("mix", "mix_n", "mix_source", "mix_rate", "mix_copy", "mix_key", "MIX_rate_n", "n", "weight")
    df = documents(spark, ROWS)
    for name in names:
        df = df.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    plain = Counter((r["doc_id"], r["source"], r["mix_copy"], r["mix_rate"], r["mix_key"]) for r in mixing.mix_sources(documents(spark, ROWS)).collect())
    out = mixing.mix_sources(df).collect()
    assert Counter((r["doc_id"], r["source"], r["mix_copy"], r["mix_rate"], r["mix_key"]) for r in out) == plain
    assert all(r[n] == (None if r["doc_id"] is None else f"{n}{r['doc_id']}") for r in out for n in ("mix", "mix_n", "mix_source", "MIX_rate_n", "n", "weight"))
    kept = mixing.replicate(df)
    assert kept.columns == df.columns and kept.count() == sum(plain.values())
    assert all(r[n] == (None if r["doc_id"] is None else f"{n}{r['doc_id']}") for r in kept.collect() for n in names)


def test_rows_without_an_id_are_spread(spark):
    from pyspark.sql import functions as F

    df = documents(spark, [(None, f"text {i}", "en", "s") for i in range(2000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in mixing.mix_sources(df, {"s": 1.0}, total=6000.0).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 2 * sum(sizes) / 4
