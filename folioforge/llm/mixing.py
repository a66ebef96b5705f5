"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, unit_hash

#: Sources up to which their rates are broadcast (about 100 bytes each).
BROADCAST_SOURCES = 10_000
#: Mean up to which one inversion is exact in doubles; larger ones are split into equal parts.
PART_MEAN = 400.0


def poisson_inverse(u: Column, mean: Column) -> Column:
    """Smallest k with P(X <= k) > u for X ~ Poisson(mean), by summing up probabilities.

    The sum ends where u is reached or, for u next to 1, once the terms have vanished.
    """
    terms = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int"))
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).alias("k"))

    def step(acc: Column, i: Column) -> Column:
        p = acc["p"] * mean / i
        more = acc["cdf"] <= u
        return F.struct(p.alias("p"), F.when(more, acc["cdf"] + p).otherwise(acc["cdf"]).alias("cdf"), F.when(more, i).otherwise(acc["k"]).alias("k"))

    return F.aggregate(terms, start, step, lambda acc: acc["k"])


def copies(mean: Column, seed: str, *key: Column) -> Column:
    """Hash-seeded Poisson count: the same key and seed give the same count in any run or partitioning."""
    parts = F.greatest(F.lit(1), F.ceil(mean / PART_MEAN).cast("int"))
    one = poisson_inverse(unit_hash(seed, *key), mean)
    many = F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda acc, i: acc + poisson_inverse(unit_hash(seed, *key, i), mean / parts))
    return F.when(mean <= 0, F.lit(0)).when(parts == 1, one).otherwise(many)


def source_rates(docs: DataFrame, target_weights: dict[str | None, float] | None = None, temperature: float = 0.5, total: float | None = None) -> DataFrame:
    """(mix_source, mix_rate): mean number of copies of a document of each source.

    A source's target share is its weight over the sum of weights; its rate is
    target share * total / number of its documents. ``target_weights`` gives
    weights by name, 0 for sources it lacks; without it a source of n documents
    weighs n ** temperature. ``total`` is the expected size of the mixture, by
    default the number of documents. Null is a source like any other.
    """
    counts = docs.groupBy(F.col("source").alias("mix_source")).agg(F.count(F.lit(1)).alias("n"))
    if target_weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, w in target_weights.items():
            weight = F.when(F.col("mix_source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    counts = materialize(counts.withColumn("weight", weight), "sources")
    whole = counts.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    if not whole["weight"]:
        return counts.select("mix_source", F.lit(0.0).alias("mix_rate"))
    size = float(whole["n"] if total is None else total)
    return counts.select("mix_source", F.round(F.col("weight") / F.lit(float(whole["weight"])) * F.lit(size) / F.col("n"), 9).alias("mix_rate"))


def _mixed(docs: DataFrame, names: tuple[str, str, str], target_weights: dict[str | None, float] | None, temperature: float, total: float | None, seed: str) -> DataFrame:
    """All columns of ``docs`` and three more of the given names, which ``docs`` lacks: rate, copy and key."""
    rate, copy, key = names
    source, n = f"{rate}_source", f"{rate}_n"
    rates = source_rates(docs, target_weights, temperature, total).toDF(source, rate)
    few = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    joined = docs.join(F.broadcast(rates) if few else rates, docs["source"].eqNullSafe(rates[source])).drop(source)
    counted = joined.withColumn(n, copies(F.col(rate), seed, F.col("doc_id"))).where(F.col(n) > 0)
    many = counted.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).drop(n)
    keyed = many.withColumn(key, unit_hash(seed + "-order", F.col("doc_id"), F.col(copy)))
    # Rows without an id have one key; what else they hold spreads them over the tasks.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    return keyed.repartition(F.col(key), spread).sortWithinPartitions(key, "doc_id", copy)


def _free_names(docs: DataFrame) -> tuple[str, str, str]:
    """Names that no column of ``docs`` begins with."""
    prefix = "mix"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    return f"{prefix}_rate", f"{prefix}_copy", f"{prefix}_key"


def mix_sources(docs: DataFrame, target_weights: dict[str | None, float] | None = None, temperature: float = 0.5, total: float | None = None, seed: str = "mix") -> DataFrame:
    """Replicate documents so that sources reach their target weights, in random order.

    Each document comes out as often as its Poisson count says, maybe never:
    this operator samples by design. Adds mix_rate (double), mix_copy (from 1)
    and mix_key (the random key of the order); columns of these names in
    ``docs`` are replaced, all others stay, whatever their names. Rows go to
    partitions by the random key and are sorted by it there, which makes the
    whole a random permutation.

    Null text, empty and very long ones are copied as they are; a null doc_id
    is a key like any other, but such rows are spread by what else they hold;
    repeated rows get the same count each. An empty table gives an empty result.
    """
    docs = docs.drop("mix_rate", "mix_copy", "mix_key")
    names = _free_names(docs)
    mixed = _mixed(docs, names, target_weights, temperature, total, seed)
    return mixed.withColumnsRenamed(dict(zip(names, ("mix_rate", "mix_copy", "mix_key"), strict=True)))


def replicate(docs: DataFrame, target_weights: dict[str | None, float] | None = None, temperature: float = 0.5, total: float | None = None, seed: str = "mix") -> DataFrame:
    """What ``mix_sources`` gives, with the columns of ``docs`` alone, all as they were."""
    return _mixed(docs, _free_names(docs), target_weights, temperature, total, seed).select(*[F.col(f"`{c}`") for c in docs.columns])
