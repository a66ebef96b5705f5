"""Merging a snapshot into a target, as pure DataFrame functions.

Spark's Parquet tables have no MERGE, UPDATE or DELETE, so each step computes
the new target from the old one. Steps that touch one table share one full
outer join. ``_action`` says what happened to a row: insert, update,
soft_delete, noop (in the snapshot, no change) or keep (not in the snapshot).

Joins with tables that grow with the catalogue ask for a sort-merge join. Spark
takes the size of ids from that of their compressed files: what it takes for a
few MB may be millions of rows, which it would bring to the driver and from
there to every executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.operators.dedup import last_wins
from folioforge.session import materialize


def distinct_from(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Row-wise IS DISTINCT FROM: nulls are equal to nulls."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))


def upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str], values: Sequence[str], soft_delete: str | None = None, scope: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The target with the staged rows merged in, and ``_action``.

    ``staged`` has one row per key. Rows of the target that it lacks stay; with
    ``soft_delete`` the flag of that name becomes true on those within
    ``scope``. Columns in ``keep`` are never updated and null on insert; new
    rows have a null ``id``.
    """
    t, s = target.alias("t"), staged.withColumn("_staged", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.withColumn("_held", F.lit(True)).alias("t").join(s, on, "full_outer")
    held, staged_here = F.col("t._held").isNotNull(), F.col("s._staged").isNotNull()
    changed = distinct_from([F.col(f"t.{v}") for v in values], [F.col(f"s.{v}") for v in values])
    gone = F.lit(False) if soft_delete is None else ~staged_here & (F.lit(True) if scope is None else scope) & ~F.coalesce(F.col(f"t.{soft_delete}"), F.lit(False))
    action = F.when(staged_here & ~held, "insert").when(staged_here & changed, "update").when(staged_here, "noop").when(gone, "soft_delete").otherwise("keep")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(f"t.{c}", f"s.{c}").alias(c))
        elif c in values:
            value = F.when(staged_here, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
            out.append((F.when(gone, F.lit(True)).otherwise(value) if c == soft_delete else value).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return joined.select(*out, action.alias("_action"))


def merge_entity(target: DataFrame, staged: DataFrame, source: int, values: Sequence[str], soft_delete: str | None = None) -> DataFrame:
    """Upsert by (source, remote_id); the last staged row of a key wins. With ``soft_delete``, rows of this source that are not staged get the flag."""
    rows = last_wins(staged, ["remote_id"]).withColumn("source", F.lit(source).cast("smallint"))
    return upsert(target, rows, ["source", "remote_id"], values, soft_delete, F.col("t.source") == source)


def flag_languages(books: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Books in a language that is not allowed count as deleted; an unknown language leaves an undeleted book's flag unknown."""
    if not allowed:
        raise ValueError("an empty list of languages would delete every book")
    return books.withColumn("is_deleted", F.col("is_deleted") | ~F.col("lang").isin(*allowed))


def assign_ids(merged: DataFrame, order: Sequence[str], top: int | None = None) -> DataFrame:
    """Ids for rows that have none: after the largest, which is ``top`` if that is known, in the order of ``order``. Old ids never change.

    New rows are sorted by ranges and written with their place in the range;
    the sizes of the ranges, one number each, give the offsets. So no task sees
    all new rows, and ids don't change when a plan runs again.
    """
    merged = materialize(merged, "merged")
    old, new = merged.where("id IS NOT NULL"), merged.where("id IS NULL").drop("id")
    if new.isEmpty():
        return old
    if top is None:
        top = old.agg(F.max("id")).first()[0] or 0
    place = F.monotonically_increasing_id()
    placed = new.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.shiftright(place, 33), "_at": place.bitwiseAND(F.lit((1 << 33) - 1))})
    placed = materialize(placed, "placed")
    offsets = []
    for part, n in sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((part, top + 1))
        top += n
    # One row for each partition of the sort.
    table = merged.sparkSession.createDataFrame(offsets, "_part long, _first long")
    numbered = placed.join(F.broadcast(table), "_part").withColumn("id", (F.col("_first") + F.col("_at")).cast(merged.schema["id"].dataType))
    return old.unionByName(numbered.select(*old.columns))


def resolve(links: DataFrame, *ends: tuple[str, DataFrame, str], source: int) -> DataFrame:
    """Replace remote ids by local ones: inner joins to the targets' rows of this source.

    An end is (column with the remote id, target, name of the local id). Links
    whose ends are unknown vanish; ends that an earlier run soft-deleted are known.
    """
    for remote, target, local in ends:
        known = target.where(F.col("source") == source).select(F.col("remote_id").alias(remote), F.col("id").alias(local))
        links = links.join(known.hint("merge"), remote).drop(remote)
    return links


def sync_links(old: DataFrame, wanted: DataFrame, books: DataFrame, source: int, ends: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """Links of this source's books, or whatever the first end is, become ``wanted``; other sources' links stay.

    ``wanted`` has one row per pair. Rows of ``old`` whose pair is wanted stay,
    with new ``values``, duplicates included; missing pairs are inserted with a
    null id; links of the source's books that are not wanted are gone. Whether a
    link is the source's depends on its book alone. One join does the upsert
    and marks the unwanted rows; the books' join finds which of those go.
    """
    merged = upsert(old, wanted, ends, values)
    mine = books.where(F.col("source") == source).select(F.col("id").alias(ends[0]), F.lit(True).alias("_mine"))
    unwanted = F.col("_action") == "keep"
    marked = merged.join(mine.hint("merge"), ends[0], "left")
    return marked.where(~(unwanted & F.col("_mine").isNotNull())).select(*old.columns, "_action")


def merge_payload(old: DataFrame, staged: DataFrame, key: str, values: Sequence[str] = ("title", "text")) -> DataFrame:
    """Upsert of texts by their owner's local id; columns that are not ``values`` stay, null on insert. Nothing is ever deleted."""
    return upsert(old, staged, [key], values)


def update_only(old: DataFrame, staged: DataFrame, key: str, value: str) -> DataFrame:
    """Set ``value`` on rows that exist and are staged; never insert, never clear."""
    new = staged.select(F.col(key).alias("_key"), F.col(value).alias("_new"))
    joined = old.join(new.hint("merge"), old[key] == F.col("_key"), "left")
    changed = F.col("_key").isNotNull() & distinct_from([F.col(value)], [F.col("_new")])
    action = F.when(changed, "update").when(F.col("_key").isNotNull(), "noop").otherwise("keep")
    return joined.select(*[(F.when(F.col("_key").isNotNull(), F.col("_new")).otherwise(F.col(c)).alias(c) if c == value else F.col(c)) for c in old.columns], action.alias("_action"))


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The latest row per key of an append-only log."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).where("_rank = 1").drop("_rank")
