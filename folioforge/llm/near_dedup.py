"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification.

1. Whole texts become sets of hashed word shingles (64 bits). Equal sets form a
   class; only its representative goes on.
2. Representatives that share a band of their MinHash signature are candidates.
   In every bucket of a band the member that meets most others is its hub.
3. Hub pairs are compared by batches of the signature. After each batch a pair
   goes if its posterior probability of reaching the threshold, given the
   matches so far, is below the chosen miss probability. Survivors are
   verified on their full sets; links give components.
4. Members of buckets that still hold several components are compared within
   their bucket, if they are tied: two sets that reach the threshold have a
   shingle in common among the few rarest that either could do without. So texts
   that share a passage but not enough of it, however many there are, don't meet.
   Tied members of different components pass the same pruning, in blocks of
   bounded size, and what survives is verified on the full sets, which stops as
   soon as components are joined. Members of one component are never paired, so
   a large group of copies costs as many rows as it has members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folioforge.llm.common import materialize, ship
from folioforge.llm.graph import components

LANES = 128
BATCH = 32
#: Bits of the membership map that tells which documents' sets are wanted, for each of them, and in all, at most (16 MB are broadcast).
MAP_BITS_EACH = 16
MAP_BITS = 1 << 27
#: Members of a block, on average; and rows of blocks that a task holds at a time.
BLOCK = 1024
GROUP_ROWS = 4096
#: Bytes of sets that a task holds at a time, on average, when it verifies pairs.
SET_BYTES = 8 << 20
#: Pairs whose lanes are compared at a time.
PAIRS = 1 << 16
#: Shingles that are hashed at a time.
CHUNK = 512
SEED = 20_240_601


@dataclass(frozen=True)
class Near:
    """``words`` per shingle; similar when 100 * intersection >= ``percent`` * union; ``miss`` bounds both the chance that banding and that pruning lose a pair at the threshold."""

    words: int = 5
    percent: int = 80
    miss: float = 1e-6

    @property
    def rows(self) -> int:
        """Most signature rows per band whose bands find a pair at the threshold with the chosen certainty."""
        t = self.percent / 100
        return max(r for r in range(1, 33) if r == 1 or (1 - t**r) ** (LANES // r) <= self.miss)

    def least_matches(self) -> list[int]:
        """For each batch: fewest matches with which a pair stays.

        With a uniform prior, P(similarity >= t | m of n match) is the chance
        that a binomial of n + 1 trials of probability t is at most m.
        """
        t, out = self.percent / 100, []
        for n in range(BATCH, LANES + 1, BATCH):
            total, m = 0.0, -1
            while total < self.miss:
                m += 1
                total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            out.append(m)
        return out


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of all words as one where there are fewer."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    n = min(words, len(h))
    acc = np.full(len(h) - n + 1, n, np.uint64)
    for j in range(n):
        acc = (acc ^ h[j : len(h) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(32)
    return np.unique(acc)


class MinHash:
    """The hash functions, and room for the values of one chunk."""

    def __init__(self) -> None:
        r = np.random.default_rng(SEED)
        self.xor = r.integers(0, 2**64, (LANES, 1), np.uint64)
        self.odd = r.integers(0, 2**63, (LANES, 1), np.uint64) * np.uint64(2) + np.uint64(1)
        self.room = np.empty((LANES, CHUNK), np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """MinHash values (uint32) of a set of any size."""
        out = np.full(LANES, 2**64 - 1, np.uint64)
        for start in range(0, len(shingles), CHUNK):
            part = shingles[None, start : start + CHUNK]
            room = self.room[:, : part.shape[1]]
            np.bitwise_xor(part, self.xor, out=room)
            np.multiply(room, self.odd, out=room)
            np.minimum(out, room.min(axis=1), out=out)
        return (out >> np.uint64(32)).astype(np.uint32)


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    n = LANES // rows
    grid = values[: n * rows].reshape(n, rows).astype(np.uint64)
    acc = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(rows):
        acc = (acc ^ grid[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return acc.view(np.int64)


def features(docs: DataFrame, near: Near) -> DataFrame:
    """(doc_id, n_shingles, digest, lanes, bands) of every row's whole text.

    ``digest`` identifies the set; a text without words gets one of its row's
    id, with which nothing is compared. ``lanes`` has the low 16 bits of each
    signature value: chance matches only keep a pair for longer.
    """
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("lanes", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    rows = near.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash()
        for batch in batches:
            n, digests, lanes, bands = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingle_set(text.as_py(), near.words)
                n.append(len(s))
                if len(s):
                    values = minhash.signature(s)
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    lanes.append((values & np.uint32(0xFFFF)).astype("<u2").tobytes())
                    bands.append(band_keys(values, rows))
                else:
                    digests.append(f"-{doc_id}".encode())
                    lanes.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(lanes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _lanes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, LANES)


def survivors(a: np.ndarray, b: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows of ``a`` and ``b`` stay to the end, and their matches."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, need in enumerate(least):
        at = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[alive, at] == b[alive, at]).sum(axis=1)
        stay = matches >= need
        alive, matches = alive[stay], matches[stay]
    return alive, matches


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on sorted sets."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def prune(pairs: DataFrame, near: Near) -> DataFrame:
    """(a, b, lanes_a, lanes_b) to the (a, b) that survive sequential comparison."""
    least = near.least_matches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive, _ = survivors(_lanes(batch.column(2)), _lanes(batch.column(3)), least)
                yield batch.select([0, 1]).take(pa.array(alive))

    return pairs.select("a", "b", "lanes_a", "lanes_b").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """(a, b) to those whose full sets are similar.

    Pairs are grouped by ``a``, whose set goes once to each group and not to
    each pair; the partners of an ``a`` are dealt to as many groups as the bytes
    of their sets need.
    """
    sizes = sets.select("id", F.octet_length("set").cast("long").alias("bytes"))
    heavy = pairs.join(sizes.select(F.col("id").alias("b"), "bytes"), "b").groupBy("a").agg(F.sum("bytes").alias("bytes"))
    # Written before it is joined: only then can Spark split the pairs of a hot member.
    heavy = materialize(heavy.select("a", "bytes", F.ceil(F.col("bytes") / SET_BYTES).cast("int").alias("salts")), "heavy")
    groups = max(1, -(-int(heavy.agg(F.sum("bytes")).first()[0] or 0) // SET_BYTES))
    group = F.pmod(F.xxhash64("a", "salt"), F.lit(groups)).alias("group")
    partners = pairs.join(heavy.select("a", "salts"), "a").withColumn("salt", F.pmod(F.xxhash64("b"), "salts").cast("int")).select(group, "a", F.col("b").alias("id")).join(sets, "id").select("group", "a", F.col("id").alias("b"), F.col("set").alias("b_set"))
    own = heavy.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).select(group, F.col("a").alias("id")).join(sets, "id").select("group", F.col("id").alias("a"), F.col("set").alias("a_set"))

    def run(one: pa.Table, many: pa.Table) -> pa.Table:
        held = {i: np.frombuffer(x.as_py(), "<u8") for i, x in zip(one["a"].to_pylist(), one["a_set"], strict=True)}
        a = many["a"].to_pylist()
        keep = [linked(held[i], np.frombuffer(x.as_py(), "<u8"), near.percent) for i, x in zip(a, many["b_set"], strict=True)]
        return pa.table({"a": pa.array(a, pa.int64()), "b": many["b"]}).filter(pa.array(keep, pa.bool_()))

    return own.groupBy("group").cogroup(partners.groupBy("group")).applyInArrow(run, "a long, b long")


def full_sets(docs: DataFrame, wanted: DataFrame, near: Near) -> DataFrame:
    """(id, set) of the wanted (id, digest), from the whole texts.

    A bit map made of the wanted ids spares the shuffle most texts that nobody
    wants; the join that follows removes the rest. It grows with their number up
    to a size, beyond which it spares less.
    """
    n = wanted.count()
    bits = max(64, min(MAP_BITS, 1 << (MAP_BITS_EACH * n).bit_length()))
    slot = F.pmod(F.xxhash64(F.col("id")), F.lit(bits))
    words = wanted.select(slot.alias("slot")).groupBy((F.col("slot") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = held.value
        for batch in batches:
            slots = batch.column(2).to_numpy()
            hit = np.flatnonzero((mask[slots >> 6] >> (slots & 63)) & 1)
            for start in range(0, len(hit), 256):
                part = batch.take(pa.array(hit[start : start + 256]))
                sets = [shingle_set(t.as_py(), near.words).astype("<u8").tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()), pa.array(sets, pa.binary())], names=["id", "digest", "set"])

    found = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id IS NOT NULL").withColumn("slot", slot).mapInArrow(run, "id long, digest binary, set binary")
    return found.join(wanted, ["id", "digest"]).groupBy("id").agg(F.first("set").alias("set"))


def rare_shingles(members: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """(id, comp, n, shingle): the rarest shingles of each member (id, comp) that another one has too.

    Of n shingles a similar set shares ``percent`` of 100 at least, so of the
    others and one more, in whatever order all sets agree on, it has one. The
    order is by the number of members that have a shingle: those that are
    alone in having theirs come first and meet no one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, comp, packed in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                values = np.frombuffer(packed.as_py(), "<u8").view(np.int64)
                for start in range(0, len(values), 1 << 16):
                    part = values[start : start + (1 << 16)]
                    m = len(part)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, i.as_py(), np.int64)), pa.array(np.full(m, comp.as_py(), np.int64)), pa.array(np.full(m, len(values), np.int64)), pa.array(part)], names=["id", "comp", "n", "shingle"])

    flat = materialize(members.join(sets, "id").select("id", "comp", "set").mapInArrow(run, "id long, comp long, n long, shingle long"), "shingles")
    # Counts are written before they are joined: only then can Spark split the rows of a common shingle.
    counts = materialize(flat.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequencies")
    mine = Window.partitionBy("id")
    ranked = flat.join(counts, "shingle").withColumns({"place": F.row_number().over(mine.orderBy("df", "shingle")), "met": F.count(F.lit(1)).over(mine)})
    spare = F.expr(f"n - cast(ceil({near.percent} * n / 100) as long) + 1")
    return ranked.where(F.col("n") - F.col("met") + F.col("place") <= spare).select("id", "comp", "n", "shingle")


def tied_members(rare: DataFrame) -> DataFrame:
    """(id, cluster): members that share a rare shingle with another component, clusters by such ties between components."""
    ends = rare.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("shingle", "low")
    # Written before it is joined, so that the members of a hot shingle can be split.
    tied = materialize(rare.join(materialize(ends, "ends"), "shingle").select("id", "comp", "low"), "tied")
    known = components(tied.select(F.col("comp").alias("a"), F.col("low").alias("b")).distinct()).select(F.col("node").alias("comp"), F.col("comp").alias("cluster"))
    return tied.select("id", "comp").distinct().join(known, "comp").select("id", "cluster")


def deal(members: DataFrame, facts: DataFrame) -> DataFrame:
    """Members (key, cluster, id, comp) to pairs of blocks (i, j) of each bucket and cluster, with their lanes and bands.

    The largest component has blocks of its own, the other members share
    blocks; blocks are dealt by a hash of the id. Pairs of blocks that only hold
    the largest component are left out.
    """
    sizes = members.groupBy("key", "cluster", "comp").agg(F.count(F.lit(1)).alias("m"))
    stats = sizes.groupBy("key", "cluster").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.max("m").alias("m_main"), F.sum("m").alias("m_all"))
    stats = stats.where("m_all > m_main").select("key", "cluster", "main", F.ceil(F.col("m_main") / BLOCK).cast("int").alias("k_main"), F.ceil((F.col("m_all") - F.col("m_main")) / BLOCK).cast("int").alias("k_pool"))
    # Written before they are joined, so that the members of a hot bucket can be split.
    dealt = members.join(materialize(stats, "stats"), ["key", "cluster"])
    is_main = F.col("comp") == F.col("main")
    block = F.when(is_main, F.pmod(F.xxhash64("id"), F.col("k_main"))).otherwise(F.col("k_main") + F.pmod(F.xxhash64("id"), F.col("k_pool"))).cast("int")
    first = F.when(is_main, F.col("k_main")).otherwise(F.lit(0))
    dealt = materialize(dealt.select("key", "cluster", "id", "comp", block.alias("block"), first.alias("first"), (F.col("k_main") + F.col("k_pool") - 1).alias("last")), "dealt")
    dealt = dealt.join(facts, "id").withColumn("other", F.explode(F.sequence("first", "last")))
    return dealt.select("key", "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "comp", "lanes", "bands")


def near_pairs(group: pa.Table, least: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, rows, matches) of pairs of different components that survive sequential comparison, some at a time.

    A pair is looked at in the first of the buckets that it shares, and nowhere else.
    """
    key = np.stack([group[c].to_numpy().astype(np.int64) for c in ("key", "cluster", "i", "j")])
    order = np.lexsort(key[::-1])
    key = key[:, order]
    block, comp, ids = (group[c].to_numpy().astype(np.int64) for c in ("block", "comp", "id"))
    lanes = _lanes(group["lanes"])
    bands = np.array(group["bands"].combine_chunks().flatten()).reshape(len(block), -1)
    edges = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0), [True]]))
    held: list[np.ndarray] = []
    waiting = 0

    def compare() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, y, bucket = np.concatenate(held, axis=1)
        held.clear()
        keep = comp[x] != comp[y]
        x, y, bucket = x[keep], y[keep], bucket[keep]
        alive, matches = survivors(lanes[x], lanes[y], least)
        x, y, bucket = x[alive], y[alive], bucket[alive]
        same = bands[x] == bands[y]
        home = bands[x, same.argmax(axis=1)] == bucket
        return x[home], y[home], matches[home]

    for a, b in zip(edges[:-1], edges[1:], strict=True):
        rows, (bucket, _, i, j) = order[a:b], key[:, a]
        left = rows[block[rows] == i]
        right = left if i == j else rows[block[rows] == j]
        for start in range(0, len(left), 64):
            part = left[start : start + 64]
            x, y = np.repeat(part, len(right)), np.tile(right, len(part))
            if i == j:
                once = ids[x] < ids[y]
                x, y = x[once], y[once]
            held.append(np.stack([x, y, np.full(len(x), bucket)]))
            waiting += len(x)
            if waiting >= PAIRS:
                yield compare()
                waiting = 0
    if held:
        yield compare()


def meetings(dealt: DataFrame, near: Near) -> DataFrame:
    """The rows of ``dealt`` without lanes and bands that have a pair which survives: what sets are fetched for."""
    least = near.least_matches()
    columns = ["key", "cluster", "i", "j", "block", "id", "comp"]
    groups = max(1, -(-dealt.count() // GROUP_ROWS))

    def run(group: pa.Table) -> pa.Table:
        hit = np.zeros(group.num_rows, bool)
        for x, y, _ in near_pairs(group, least):
            hit[x] = hit[y] = True
        return group.select(columns).filter(pa.array(hit))

    keyed = dealt.withColumn("group", F.pmod(F.xxhash64("key", "cluster", "i", "j"), F.lit(groups)))
    return keyed.groupBy("group").applyInArrow(run, "key long, cluster long, i int, j int, block int, id long, comp long")


def late_links(met: DataFrame, facts: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """(a, b): components that links between the rows of ``meetings`` join.

    Pairs with most matches are verified first, and none whose components are joined already.
    """
    least = near.least_matches()
    total = met.join(sets.select("id", F.octet_length("set").cast("long").alias("bytes")), "id").agg(F.sum("bytes")).first()[0]
    groups = max(1, -(-int(total or 0) // SET_BYTES))

    def run(group: pa.Table) -> pa.Table:
        comp = group["comp"].to_numpy()
        sets = [np.frombuffer(s.as_py(), "<u8") for s in group["set"]]
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        out: list[tuple[int, int]] = []
        for x, y, matches in near_pairs(group, least):
            for k in np.argsort(-matches, kind="stable"):
                p, q = top(int(comp[x[k]])), top(int(comp[y[k]]))
                if p != q and linked(sets[x[k]], sets[y[k]], near.percent):
                    root[max(p, q)] = min(p, q)
                    out.append((int(comp[x[k]]), int(comp[y[k]])))
        return pa.table({"a": pa.array([p for p, _ in out], pa.int64()), "b": pa.array([q for _, q in out], pa.int64())})

    keyed = met.join(facts, "id").join(sets, "id").withColumn("group", F.pmod(F.xxhash64("key", "cluster", "i", "j"), F.lit(groups)))
    return keyed.groupBy("group").applyInArrow(run, "a long, b long")


def near_dedup(docs: DataFrame, near: Near | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents are linked when their shingle sets reach the threshold;
    component_id is the smallest doc_id that links reach, and kept says that
    it is the row's own. Texts that are null, empty or without words have an
    empty set, are linked with nothing and are kept. Repeated rows share a
    component; if the kept doc_id repeats, all its rows are kept. A row without
    an id takes its component from rows with the same set, else null, and is
    kept in the latter case. An empty table gives an empty one; very long texts
    are read whole. Other columns, whatever their names, are not read.
    """
    near = near or Near()
    ship(docs.sparkSession)
    rows = materialize(features(docs, near), "features")
    classes = rows.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("lanes").alias("lanes"), F.first("bands").alias("bands")).where("id IS NOT NULL")
    classes = materialize(classes, "classes")
    labels = _class_components(docs, classes, near)
    named = classes.select("digest", "id").join(labels, classes["id"] == labels["node"], "left").select("digest", F.coalesce("comp", "id").alias("found"))
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("found"))
    return rows.join(named, "digest", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _class_components(docs: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """(node, comp) of the representatives that have links."""
    keys = classes.select(F.explode("bands").alias("key"), "id")
    # Counts are written before they are joined: only then can Spark split the rows of a hot key.
    shared = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    members = materialize(keys.join(shared, "key"), "members")
    wanted = members.select("id").distinct().join(classes.select("id", "digest", "lanes", "bands"), "id")
    wanted = materialize(wanted, "wanted")
    sets = materialize(full_sets(docs, wanted.select("id", "digest"), near), "sets")
    lanes = wanted.select("id", "lanes")

    reach = members.groupBy("id").agg(F.sum("n").alias("reach"))
    hubs = materialize(members.join(reach, "id").groupBy("key").agg(F.max_by("id", F.struct("reach", "id")).alias("hub")), "hubs")
    pairs = members.join(hubs, "key").where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = materialize(verify(materialize(prune(_both(pairs, lanes), near), "pairs"), sets, near), "links")
    labels = components(links)

    known = members.join(labels, members["id"] == labels["node"], "left").select("key", "id", "n", F.coalesce("comp", "id").alias("comp"))
    # A bucket of two has been compared as a whole.
    mixed = known.where("n > 2").groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    mixed = materialize(mixed, "buckets")
    left = materialize(known.join(mixed, "key").select("key", "id", "comp"), "mixed")
    if left.isEmpty():
        return labels
    tied = tied_members(materialize(rare_shingles(left.select("id", "comp").distinct(), sets, near), "rare"))
    facts = wanted.select("id", "lanes", "bands")
    dealt = materialize(deal(materialize(left.join(tied, "id"), "bucketed"), facts), "blocks")
    if dealt.isEmpty():
        return labels
    more = materialize(late_links(materialize(meetings(dealt, near), "met"), facts, sets, near), "more")
    if more.isEmpty():
        return labels
    joined = components(more).select(F.col("node").alias("low"), F.col("comp").alias("lower"))
    ids = members.select("id").distinct()
    own = ids.join(labels, ids["id"] == labels["node"], "left").select(F.col("id").alias("node"), F.coalesce("comp", "id").alias("comp"))
    return own.join(joined, own["comp"] == joined["low"], "left").select("node", F.coalesce("lower", "comp").alias("comp"))


def _both(pairs: DataFrame, lanes: DataFrame) -> DataFrame:
    """Give both members of a pair their lanes."""
    one = lanes.select(F.col("id").alias("a"), F.col("lanes").alias("lanes_a"))
    two = lanes.select(F.col("id").alias("b"), F.col("lanes").alias("lanes_b"))
    return pairs.join(one, "a").join(two, "b")
