"""Exact duplicates through a minimal perfect hash over historical digests.

The digests of the history are dealt to shards. Each shard gets a minimal
perfect hash function (levels of bit arrays: a digest stays on the first level
where it falls on a bit alone) and a slot table in its order. A slot holds the
whole digest and the locator of the winner. A lookup computes the slot and
compares all bytes of the digest, so that a stranger is never taken for a
member; strangers form groups of their own.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.common import materialize, ship, shuffle_partitions

#: Bits of a level for each digest that reaches it.
GAMMA = 2
#: Digests that a shard holds at most, on average.
SHARD_DIGESTS = 20_000
WIDTH = 32


def text_digest(text: Column | str) -> Column:
    """SHA-256 (binary) of the text in UTF-8; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class PerfectHash:
    """Minimal perfect hash over the rows of a (n, 32) array of distinct digests."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        words = digests.view("<u8").reshape(-1, WIDTH // 8)
        with np.errstate(over="ignore"):
            h = (words[:, level % 4] ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(31)) ^ words[:, (level + 1) % 4]) * np.uint64(0x94D049BB133111EB)
        return ((h ^ (h >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        left, sizes, levels = np.ascontiguousarray(digests), [], []
        while len(left):
            size = GAMMA * len(left)
            at = cls._place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = np.ascontiguousarray(left[~alone[at]])
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """Slot of each digest; -1 for some that are not members, any slot for the others."""
        digests = np.ascontiguousarray(digests)
        out, base = np.full(len(digests), -1, np.int64), 0
        left = np.arange(len(digests))
        for level, size in enumerate(self.sizes):
            at = base + self._place(digests[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
            if not len(left):
                break
        return out

    def to_bytes(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], "<i8").tobytes() + np.packbits(self.bits).tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        sizes = np.frombuffer(raw, "<i8", n, 8).tolist()
        return cls(sizes, np.unpackbits(np.frombuffer(raw, np.uint8, offset=8 * (n + 1)), count=sum(sizes)).astype(bool) if n else np.zeros(0, bool))


INDEX = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("hash", T.BinaryType()), T.StructField("digests", T.BinaryType()), T.StructField("winners", T.BinaryType()), T.StructField("sizes", T.BinaryType())])
GROUPS = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("keep_id", T.LongType()), T.StructField("group_size", T.LongType())])
#: Locator of a group whose ids are all null.
NO_ID = -(2**63)


def _rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def shard_of(digest: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


def group_digests(digests: DataFrame) -> DataFrame:
    """(doc_id, digest) to (digest, keep_id, group_size): combined in each task before the shuffle."""
    return digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the perfect hash and its slots. ``groups`` has one row per distinct digest."""
    ship(groups.sparkSession)

    def build(group: pa.Table) -> pa.Table:
        digests = _rows(group["digest"])
        mph = PerfectHash.build(digests)
        at = mph.slots(digests)
        slots, winners, sizes = np.empty_like(digests), np.empty(len(at), "<i8"), np.empty(len(at), "<i8")
        slots[at] = digests
        winners[at] = group["keep_id"].fill_null(NO_ID).to_numpy()
        sizes[at] = group["group_size"].to_numpy()
        return pa.table({"shard": pa.array([group["shard"][0].as_py()], pa.int32()), "hash": [mph.to_bytes()], "digests": [slots.tobytes()], "winners": [winners.tobytes()], "sizes": [sizes.tobytes()]})

    return groups.withColumn("shard", shard_of(F.col("digest"), shards)).groupBy("shard").applyInArrow(build, INDEX)


def lookup(index: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """The groups of history and batch together: (digest, keep_id, group_size).

    Batch groups that are members update their slot's locator and size; the
    others come out as groups of their own.
    """
    ship(groups.sparkSession)

    def probe(held: pa.Table, batch: pa.Table) -> pa.Table:
        rows = _rows(batch["digest"]) if batch.num_rows else np.empty((0, WIDTH), np.uint8)
        ids, counts = batch["keep_id"].fill_null(NO_ID).to_numpy(), batch["group_size"].to_numpy()
        slots, winners, sizes = np.empty((0, WIDTH), np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
        if held.num_rows:
            mph = PerfectHash.from_bytes(held["hash"][0].as_py())
            slots = np.frombuffer(held["digests"][0].as_py(), np.uint8).reshape(-1, WIDTH)
            winners, sizes = (np.frombuffer(held[c][0].as_py(), "<i8").copy() for c in ("winners", "sizes"))
            at = mph.slots(rows)
            member = at >= 0
            member[member] = (slots[at[member]] == rows[member]).all(axis=1)
            winners[at[member]] = np.maximum(winners[at[member]], ids[member])
            sizes[at[member]] += counts[member]
            rows, ids, counts = rows[~member], ids[~member], counts[~member]
        keep = np.concatenate([winners, ids])
        return pa.table({"digest": pa.array([r.tobytes() for part in (slots, rows) for r in part], pa.binary()), "keep_id": pa.array(keep, pa.int64(), mask=keep == NO_ID), "group_size": pa.array(np.concatenate([sizes, counts]), pa.int64())})

    with_shard = groups.withColumn("shard", shard_of(F.col("digest"), shards))
    return index.groupBy("shard").cogroup(with_shard.groupBy("shard")).applyInArrow(probe, GROUPS)


def exact_dedup(docs: DataFrame, historical: Column | None = None, shards: int | None = None) -> DataFrame:
    """Groups of equal texts; of each, the row with the largest doc_id stays.

    Returns a row for each row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256. ``historical`` says which rows form the indexed history (by
    default about half, by a hash of doc_id); the others are looked up in it.
    The result does not depend on the choice.

    Null text counts as empty, so null and empty texts form one group. Null ids
    lose to all others; keep_id is null only if all ids of a group are. Rows
    that repeat the winning doc_id are one document given twice: all are kept.
    Texts of any length are hashed whole; other columns are not read.
    """
    spark = docs.sparkSession
    historical = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0 if historical is None else historical
    digests = materialize(docs.select("doc_id", text_digest("text").alias("digest"), historical.alias("old")), "digests")
    n = digests.count()
    shards = shards or max(4 * shuffle_partitions(spark), -(-n // SHARD_DIGESTS))
    index = build_index(group_digests(digests.where("old")), shards)
    groups = lookup(index, group_digests(digests.where("NOT coalesce(old, false)")), shards)
    # A hot digest meets one row of groups: the skewed side of this join can be split.
    return (
        digests.join(groups, "digest")
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    )
