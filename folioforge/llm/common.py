"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import materialize, scratch_path, ship

__all__ = ["materialize", "scratch_path", "ship", "shuffle_partitions", "table", "unit_hash"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unit_hash(*parts: Column | str) -> Column:
    """A double in [0, 1): the first 13 hex digits of the md5 of the parts joined by ':'."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
