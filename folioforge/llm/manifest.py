"""Merkle manifest of a dataset: a tree for each group of rows, and a tree over the groups' roots.

Leaves are digests of rows. They are numbered within their group by a sort by
ranges, so no task sees a whole group. On every level a node's run is ``arity``
consecutive nodes; each node finds the others of its run by equijoins with
computed indices (itself shifted by one slot, by two, ...), and the node in slot
zero, which then has the digests of the run, emits the parent. What remains of
a group is its root; the roots, in the order of the groups, make a tree of the
same kind. Proofs are handed down from the top: a node's path is its own
siblings and then its parent's path.

All levels are written to the shared folder, and every join is by (group, index
within the group), so a group that holds most rows is spread like all others.
Digests are kept as 32 bytes; where one is hashed again it counts as its lower
case hex text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.llm.common import materialize

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
_PATH = "array<struct<before:binary,after:binary>>"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the given columns, ``leaf``, ``subroot`` (binary) and ``path``, from the leaf up to the root: digests before and after the node in its run. ``groups``: (group, rows, subroot). ``root``: hex, null without rows."""

    leaves: DataFrame
    groups: DataFrame
    root: str | None


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the values one after the other: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx``, the place within ``grp`` by ``order``, and ``n``, the group's size.

    Rows are sorted by ranges and written with their place in the partition; how
    many rows of each group a partition has, one number each, gives the offsets.
    """
    at = F.monotonically_increasing_id()
    sorted_rows = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    placed = materialize(sorted_rows.withColumns({"part": F.shiftright(at, 33), "at": at.bitwiseAND(F.lit((1 << 33) - 1))}), "placed")
    counts = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("first"))
    # A group has a row for each partition here, not for each of its rows.
    group = Window.partitionBy("grp")
    before = F.sum("here").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("here")
    offsets = counts.select("grp", "part", (before - F.col("first")).alias("shift"), F.sum("here").over(group).alias("n"))
    return placed.join(offsets, ["grp", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _level(nodes: DataFrame, arity: int) -> DataFrame:
    """(grp, idx, n, digest, before, after): every node with the digests of its run, found by its siblings' indices."""
    slot = F.col("idx") % arity
    out = nodes.select("grp", "idx", "n", "digest", slot.alias("slot"))
    for shift in range(1, arity):
        other = nodes.select("grp", F.col("idx").alias(f"idx{shift}"), F.col("digest").alias(f"digest{shift}"))
        out = out.withColumn(f"idx{shift}", F.col("idx") - F.col("slot") + (F.col("slot") + shift) % arity).join(other, ["grp", f"idx{shift}"], "left")
    # The last run may lack some.
    family = [F.struct(F.col(f"idx{s}").alias("i"), F.col(f"digest{s}").alias("d")) for s in range(1, arity)]
    there = F.sort_array(F.filter(F.array(*family), lambda x: x["d"].isNotNull()))

    def side(keep: Column) -> Column:
        return F.aggregate(F.filter(there, lambda x: (x["i"] < F.col("idx")) == keep), F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["d"]))

    return out.select("grp", "idx", "n", "digest", side(F.lit(True)).alias("before"), side(F.lit(False)).alias("after"))


def _climb(leaves: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """Written levels of nodes that have a parent, from the leaves up, and (grp, digest) of what remains of each group."""
    nodes = leaves.select("grp", "idx", "n", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], nodes.where("n = 1")
    while most > 1:
        level = materialize(_level(nodes.where("n > 1"), arity), "level")
        levels.append(level)
        parent = F.unhex(F.sha2(F.concat(_text(F.col("digest")), _text(F.col("after"))), 256))
        nodes = level.where(F.col("idx") % arity == 0).select("grp", (F.col("idx") / arity).cast("long").alias("idx"), F.ceil(F.col("n") / arity).alias("n"), parent.alias("digest"))
        roots = roots.unionByName(nodes.where("n = 1"))
        most = -(-most // arity)
    return levels, roots.select("grp", "digest")


def _descend(levels: list[DataFrame], tops: DataFrame, arity: int, leaves: DataFrame) -> DataFrame:
    """(grp, idx, path, subroot) of every leaf; ``tops`` has (grp, path, subroot) of the groups' roots."""
    sizes = leaves.select("grp", "n").where("idx = 0")
    # The level on which a group's root stands follows from its size; from there its path goes down.
    height, above = F.lit(0), None
    for k in range(1, len(levels) + 1):
        height = F.when(F.col("n") > arity ** (k - 1), F.lit(k)).otherwise(height)
    tops = materialize(tops.join(sizes, "grp").select("grp", F.lit(0).cast("long").alias("idx"), "path", "subroot", height.alias("height")), "tops")
    for k in range(len(levels), -1, -1):
        here = tops.where(F.col("height") == k).drop("height")
        if above is not None:
            nodes = levels[k].select("grp", "idx", (F.col("idx") / arity).cast("long").alias("up"), F.struct("before", "after").alias("own"))
            parents = above.withColumnRenamed("idx", "up")
            down = nodes.join(parents, ["grp", "up"]).select("grp", "idx", F.concat(F.array("own"), F.col("path")).alias("path"), "subroot")
            here = here.unionByName(down)
        above = here
    return above


def manifest(docs: DataFrame, keep: Mapping[str, Column], group: str = "source", order: str = "doc_id", columns: Sequence[str] = COLUMNS, arity: int = ARITY) -> Manifest:
    """The manifest of all rows: one leaf each, ordered by ``order`` within ``group``; ``keep`` names columns that leaves carry.

    Null groups form a group, which comes first; groups then follow bytewise. A
    null ``order`` comes first; rows that tie are ordered by their digests, so
    repeated rows are interchangeable, and each has its own place. Null values
    have an encoding of their own, and empty texts another. Texts may be of any
    length. Columns that are not named are not read, whatever their names. A
    group of one row has no level of its own. An empty table has no root.
    """
    if arity < 2:
        raise ValueError("a run of less than two nodes has no parent")
    grp = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    # "-" sorts before "=", and a common first letter leaves the order of the others as it is.
    rows = docs.select(grp.alias("grp"), F.col(order).alias("ord"), row_digest([F.col(c) for c in columns]).alias("digest"), F.struct(*[c.alias(n) for n, c in keep.items()]).alias("kept"))
    leaves = materialize(_numbered(materialize(rows, "leaves"), ["ord", "digest"]), "numbered")
    levels, roots = _climb(leaves, arity)
    subroots = materialize(_numbered(roots.select(F.lit("").alias("grp"), F.col("grp").alias("ord"), "digest"), ["ord"]), "subroots")
    upper, top = _climb(subroots, arity)
    last = top.take(1)
    none = F.lit(None).cast(_PATH)
    above = _descend(upper, top.select("grp", F.coalesce(none, F.array()).alias("path"), F.col("digest").alias("subroot")), arity, subroots)
    tops = subroots.join(above.select("idx", "path"), "idx").select(F.col("ord").alias("grp"), "path", F.col("digest").alias("subroot"))
    paths = _descend(levels, tops, arity, leaves)
    joined = leaves.join(paths, ["grp", "idx"]).select("kept.*", F.col("digest").alias("leaf"), "subroot", "path")
    name = F.when(F.col("ord") == "-", None).otherwise(F.substring("ord", 2, 1 << 30))
    groups = subroots.join(leaves.where("idx = 0").select(F.col("grp").alias("ord"), F.col("n").alias("rows")), "ord").select(name.alias("group"), "rows", F.col("digest").alias("subroot"))
    return Manifest(joined, groups, last[0]["digest"].hex() if last else None)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: _text(F.concat(s["before"], s["after"]))), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """Hex root that a leaf (binary) and its path lead to."""
    return F.aggregate(path, _text(leaf), lambda acc, s: F.sha2(F.concat(_text(s["before"]), acc, _text(s["after"])), 256))


def tamper_report(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: each row's proof, tried on a copy in which some texts were tampered with.

    Where 2 divides the CRC-32 of the decimal doc_id, the copy's text has lost
    its newlines; without a doc_id, or a text, nothing changes. ``folded_root``
    is computed from the copy's leaf and the manifest's siblings. Null, empty,
    long, tied and repeated rows: see ``manifest``.
    """
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    seen = F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    copy = row_digest([seen if c == "text" else F.col(c) for c in COLUMNS])
    made = manifest(docs, {"doc_id": F.col("doc_id"), "copy": copy})
    out = made.leaves.select("doc_id", _text(F.col("leaf")).alias("leaf"), _text(F.col("subroot")).alias("subroot"), F.lit(made.root).cast("string").alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("copy"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
