"""Repeated passages: bytes covered by a string of fixed length that also starts anywhere else.

1. Every window of ``length`` bytes has an anchor, the smallest hash among its
   grams of ``GRAM`` bytes. Equal windows have equal anchors. Neighbouring
   windows with one anchor form a segment; texts are told apart by a digest, and
   so are the bytes of segments.
2. An anchor that occurs once, once in its segment too, is no repeat's. Of the
   others, segments that occur again byte by byte are repeated as a whole, at
   the cost of a count, however many copies there are.
3. What is left are segments that occur once and share their anchor with other
   bytes. Only those anchors' segments are read again, one of each kind; each
   task puts the suffixes of some anchors' segments in order (``suffix_array``),
   and equal windows stand side by side.
4. An anchor with more different segments than a task should hold is divided:
   each half of the distances between a window and its anchor has a larger part
   of the text in common, whose hash is the new anchor. What was too large falls
   apart into equal, single and few segments, at the latest when a segment is
   one window. So no group has to fit into a task.
5. Spans go back to their texts, and the texts give up the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, shuffle_partitions, ship
from folioforge.llm.suffix_array import suffix_array

#: Bytes of the grams whose hashes are anchors; shorter ones repeat by chance more often, longer ones make shorter segments.
GRAM = 64
#: Windows of a text that are looked at together.
CHUNK = 1 << 16
#: Bytes of an anchor's different segments that a task puts in order; beyond it they are divided.
GROUP_BYTES = 1 << 17
#: Bits of the membership map of anchors that are read again, for each of them, and in all, at most (16 MB are broadcast).
MAP_BITS_EACH = 16
MAP_BITS = 1 << 27
_BASE = 0x9E3779B97F4A7C15
_SEGMENT = "key long, id binary, start long, windows int, kind binary, again boolean"


@dataclass(frozen=True)
class Repeats:
    """Strings of ``length`` bytes; ``group_bytes`` bounds what a task puts in order for one anchor, before it is divided."""

    length: int = 400
    group_bytes: int = GROUP_BYTES

    def __post_init__(self) -> None:
        if self.length < 2:
            raise ValueError("a repeat has at least two bytes")

    @property
    def gram(self) -> int:
        return min(GRAM, self.length // 2)


def _extreme(values: np.ndarray, width: int, of: np.ufunc, fill: int) -> np.ndarray:
    """Smallest or largest of every ``width`` neighbours, by running extremes of blocks from both ends."""
    n = len(values) - width + 1
    whole = -(-len(values) // width) * width
    blocks = np.full(whole, fill, values.dtype)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = of.accumulate(blocks, axis=1).ravel()
    back = of.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return of(back[:n], ahead[width - 1 : width - 1 + n])


@dataclass
class Segments:
    """Segments of several texts laid end to end in ``data``: the text's row, the first window's place in the text and in ``data``, windows, anchors, the anchor's place in the segment, and whether it occurs again there."""

    data: bytes
    row: np.ndarray
    start: np.ndarray
    at: np.ndarray
    windows: np.ndarray
    key: np.ndarray
    anchor: np.ndarray
    again: np.ndarray


class Anchors:
    """Finds segments."""

    def __init__(self, rule: Repeats):
        self.length, self.gram = rule.length, rule.gram
        self.width = rule.length - rule.gram + 1
        n = 2 * (CHUNK + rule.length)
        self.up = np.ones(n, np.uint64)
        np.cumprod(np.full(n - 1, _BASE, np.uint64), out=self.up[1:])
        self.down = np.ones(n, np.uint64)
        np.cumprod(np.full(n - 1, pow(_BASE, -1, 1 << 64), np.uint64), out=self.down[1:])

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash of every gram, by differences of running sums."""
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.down[:n], out=sums[1:])
        h = (sums[self.gram :] - sums[: n - self.gram + 1]) * self.up[: n - self.gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h

    def of(self, texts: pa.Array) -> Iterator[Segments]:
        """Segments of all texts, a bounded number of bytes at a time; long texts in parts that share no window."""
        parts: list[tuple[int, int, bytes]] = []
        size = 0
        for row, text in enumerate(texts):
            raw = text.as_py()
            for at in range(0, len(raw) - self.length + 1, CHUNK):
                part = raw[at : at + CHUNK + self.length - 1] if len(raw) > CHUNK else raw
                parts.append((row, at, part))
                size += len(part)
                if size >= CHUNK:
                    yield self._segments(parts)
                    parts, size = [], 0
        if parts:
            yield self._segments(parts)

    def _segments(self, parts: list[tuple[int, int, bytes]]) -> Segments:
        data = b"".join(p for _, _, p in parts)
        ends = np.cumsum([len(p) for _, _, p in parts])
        begins = np.concatenate([[0], ends[:-1]])
        h = self.hashes(np.frombuffer(data, np.uint8))
        least = _extreme(h, self.width, np.minimum, (1 << 64) - 1)
        n = len(least)
        # A segment ends where the anchor changes, and at the last window of a text; windows across texts make none.
        lasts = ends - self.length + 1
        cuts = np.unique(np.concatenate([np.flatnonzero(least[1:] != least[:-1]) + 1, begins, lasts, [n]]))
        first, end = cuts[:-1], cuts[1:]
        part = np.searchsorted(ends, first, "right")
        real = first < lasts[part]
        first, end, part = first[real], end[real], part[real]
        key = least[first]
        # Places where some window has its smallest hash.
        padded = np.zeros(n + 2 * self.width - 2, np.uint64)
        padded[self.width - 1 : self.width - 1 + n] = least
        chosen = np.flatnonzero(_extreme(padded, self.width, np.maximum, 0) == h)
        a, b = np.searchsorted(chosen, first), np.searchsorted(chosen, end + self.width - 1)
        values, times, anchor = h[chosen], np.zeros(len(first), np.int64), np.full(len(first), -1)
        for t in range(min(int((b - a).max()), 64)):
            here = np.minimum(a + t, len(values) - 1)
            same = (a + t < b) & (values[here] == key)
            anchor = np.where(same & (anchor < 0), chosen[here] - first, anchor)
            times += same
        again = (times != 1) | (b - a > 64)
        rows, offsets = np.array([r for r, _, _ in parts]), np.array([o for _, o, _ in parts])
        return Segments(data, rows[part], offsets[part] + first - begins[part], first, end - first, key, np.where(again, -1, anchor), again)


def _kind(piece: bytes) -> bytes:
    return hashlib.sha256(piece).digest()[:16]


def _segments(docs: DataFrame, rule: Repeats) -> DataFrame:
    """(key, id, start, windows, kind, again) of every segment of every text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, wide = Anchors(rule), rule.length - 1
        for batch in batches:
            for s in anchors.of(batch["text"]):
                kinds = [_kind(s.data[a:b]) for a, b in zip(s.at.tolist(), (s.at + s.windows + wide).tolist(), strict=True)]
                yield pa.record_batch([pa.array(s.key.view(np.int64)), batch["id"].take(pa.array(s.row)), pa.array(s.start), pa.array(s.windows.astype(np.int32)), pa.array(kinds, pa.binary()), pa.array(s.again)], names=["key", "id", "start", "windows", "kind", "again"])

    return docs.select("id", "text").mapInArrow(find, _SEGMENT)


def _bytes_of(docs: DataFrame, wanted: DataFrame, rule: Repeats) -> DataFrame:
    """(key, kind, piece): one segment of each kind of the wanted keys, and of a few others.

    A bit map of the wanted keys says which segments leave their task; where it
    is full, more do, and no result depends on it.
    """
    n = wanted.count()
    bits = max(64, min(MAP_BITS, 1 << (MAP_BITS_EACH * n).bit_length()))
    slot = F.pmod(F.col("key"), F.lit(bits))
    words = wanted.select(slot.alias("slot")).groupBy((F.col("slot") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, wide, known = Anchors(rule), rule.length - 1, held.value.view(np.uint64)
        for batch in batches:
            seen: set[tuple[int, bytes]] = set()
            for s in anchors.of(batch["text"]):
                at_bit = s.key & np.uint64(bits - 1)
                hit = np.flatnonzero((known[(at_bit >> np.uint64(6)).astype(np.int64)] >> (at_bit & np.uint64(63))) & np.uint64(1))
                rows = []
                for key, a, n, anchor in zip(s.key.view(np.int64)[hit].tolist(), s.at[hit].tolist(), s.windows[hit].tolist(), s.anchor[hit].tolist(), strict=True):
                    piece = s.data[a : a + n + wide]
                    kind = _kind(piece)
                    if (key, kind) not in seen:
                        seen.add((key, kind))
                        rows.append((key, kind, piece, anchor))
                columns = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.int32()), strict=True)], names=["key", "kind", "piece", "anchor"])

    found = docs.select("id", "text").mapInArrow(read, "key long, kind binary, piece binary, anchor int")
    # Equal pieces have their anchor at the same place.
    return found.groupBy("key", "kind").agg(F.first("piece").alias("piece"), F.first("anchor").alias("anchor"))


def equal_windows(pieces: list[bytes], anchors: list[int], length: int) -> list[np.ndarray]:
    """For each piece, where windows start that also start elsewhere in the pieces, as a mask over its windows.

    All windows of a piece reach its anchor, and equal windows do so at the same
    distance. So what follows from the anchor on counts as one symbol, by its
    rank among all pieces, and only what precedes it is put in order letter by
    letter. Pieces with -1 are put in order whole; they don't match the others.
    """
    tails = [p[a:] if a >= 0 else b"" for p, a in zip(pieces, anchors, strict=True)]
    rank = {tail: 257 + k for k, tail in enumerate(sorted(set(tails)))}
    symbols, places, at = [], [], 0
    for p, a, tail in zip(pieces, anchors, tails, strict=True):
        symbols.append(np.frombuffer(p[:a] if a >= 0 else p, np.uint8).astype(np.int32) + 1)
        # The letter at the anchor begins the last window, if any; it stands for the tail.
        symbols.append(np.array([rank[tail] if a >= 0 else 0], np.int32))
        n = len(p) - length + 1
        places.append((at, n))
        at += len(symbols[-2]) + 1
    window = np.zeros(at + 1, bool)
    offset = np.zeros(at + 1, np.int64)
    joined = b"".join(pieces)
    begin = 0
    for (a, n), p in zip(places, pieces, strict=True):
        window[a : a + n] = True
        offset[a : a + n] = np.arange(begin, begin + n)
        begin += len(p)
    order = np.asarray(suffix_array(np.concatenate(symbols).tolist()), np.int64)
    order = order[window[order]]
    starts = offset[order].tolist()
    equal = np.zeros(len(starts) + 1, bool)
    equal[1:-1] = [joined[a : a + length] == joined[b : b + length] for a, b in zip(starts, starts[1:], strict=False)]
    repeated = np.zeros(at + 1, bool)
    repeated[order[equal[:-1] | equal[1:]]] = True
    return [repeated[a : a + n] for a, n in places]


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


_FOUND = "key long, kind binary, low int, high int"


def _ordered(pieces: DataFrame, rule: Repeats) -> DataFrame:
    """(key, kind, low, high): windows of a segment, from ``low`` up to ``high``, that are found elsewhere among its key's segments."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, bytes, bytes, int]] = []
        size, last = 0, None
        for batch in batches:
            for key, kind, piece, anchor in zip(batch["key"].to_pylist(), batch["kind"].to_pylist(), batch["piece"].to_pylist(), batch["anchor"].to_pylist(), strict=True):
                # Keys don't match each other, so several are put in order at once.
                if size > rule.group_bytes and key != last:
                    yield found(rows)
                    rows, size = [], 0
                rows.append((key, kind, piece, anchor))
                size += len(piece)
                last = key
        if rows:
            yield found(rows)

    def found(rows: list[tuple[int, bytes, bytes, int]]) -> pa.RecordBatch:
        # Where an anchor is not unique in one of its segments, none of them may rely on its place.
        whole = {key for key, _, _, anchor in rows if anchor < 0}
        # What precedes the anchors is put in order; of a key's segments, read backwards where that is shorter.
        surplus: dict[int, int] = {}
        for key, _, piece, anchor in rows:
            surplus[key] = surplus.get(key, 0) + 2 * anchor + rule.gram - len(piece)
        turned = {key for key, n in surplus.items() if n > 0} - whole
        out = []
        # Apart from each other: a segment read backwards may be like another key's read forwards.
        for back in (False, True):
            some = [r for r in rows if (r[0] in turned) == back]
            pieces = [piece[::-1] if back else piece for _, _, piece, _ in some]
            anchors = [-1 if key in whole else len(piece) - rule.gram - anchor if back else anchor for key, _, piece, anchor in some]
            masks = equal_windows(pieces, anchors, rule.length) if some else []
            out += [(key, kind, a, b) for (key, kind, _, _), mask in zip(some, masks, strict=True) for a, b in _runs(mask[::-1] if back else mask)]
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int32(), pa.int32()), strict=True)], names=["key", "kind", "low", "high"])

    # The work is in the tasks, not in the bytes that they read: they are not to be made fewer.
    return pieces.repartition(shuffle_partitions(pieces.sparkSession), "key").sortWithinPartitions("key").mapInArrow(sort, _FOUND)


_PART = pa.schema([("key", pa.int64()), ("kind", pa.binary()), ("piece", pa.binary()), ("anchor", pa.int32()), ("windows", pa.int32()), ("near", pa.int32()), ("far", pa.int32()), ("of_key", pa.int64()), ("of_kind", pa.binary()), ("shift", pa.int32())])
_PARTS = "key long, kind binary, piece binary, anchor int, windows int, near int, far int, of_key long, of_kind binary, shift int"


def _halves(parts: DataFrame, rule: Repeats) -> DataFrame:
    """Both halves of each part, those without windows left out.

    A part holds the windows of a segment whose distance to their anchor, the
    first at or after their start, is ``near`` or more and below ``far``.
    """
    length = rule.length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                middle, q, piece = (r["near"] + r["far"]) // 2, r["anchor"], r["piece"]
                for near, far in ((r["near"], middle), (middle, r["far"])):
                    low, high = max(0, q - far + 1), min(r["windows"], q - near + 1)
                    if near < far and low < high:
                        half, shared = piece[low : high + length - 1], piece[q - near : q - far + 1 + length]
                        key = hashlib.sha256(b"%d %d %d " % (r["key"], near, far) + shared).digest()[:8]
                        out.append((int.from_bytes(key, "little", signed=True), _kind(half), half, q - low, high - low, near, far, r["of_key"], r["of_kind"], r["shift"] + low))
            columns = list(zip(*out, strict=True)) or [()] * len(_PART)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PART, strict=True)], schema=_PART)

    return parts.mapInArrow(cut, _PARTS)


def _whole_parts(pieces: DataFrame, rule: Repeats) -> DataFrame:
    """Segments as parts with all distances; where the anchor occurs more than once, one for each place."""
    length = rule.length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(rule)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                piece, windows = r["piece"], len(r["piece"]) - length + 1
                places = [r["anchor"]]
                if r["anchor"] < 0:
                    places = np.flatnonzero(finder.hashes(np.frombuffer(piece, np.uint8)).view(np.int64) == r["key"]).tolist()
                low = 0
                for q in places:
                    high = min(windows, q + 1)
                    if low < high:
                        out.append((r["key"], r["kind"], piece[low : high + length - 1], q - low, high - low, 0, finder.width, r["key"], r["kind"], low))
                    low = max(low, high)
            columns = list(zip(*out, strict=True)) or [()] * len(_PART)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PART, strict=True)], schema=_PART)

    return pieces.mapInArrow(cut, _PARTS)


def _divided(pieces: DataFrame, rule: Repeats) -> DataFrame:
    """What ``_ordered`` gives, for keys with more segments than a task should hold; each round halves the distances."""
    out, parts, left = None, materialize(_whole_parts(pieces, rule), "parts"), (rule.length - rule.gram + 1).bit_length() + 1
    while left and not parts.isEmpty():
        left -= 1
        parts = materialize(_halves(parts, rule), "parts")
        one = F.count(F.lit(1))
        # One part of each kind goes on; all places of those that occur again are repeats.
        kinds = materialize(parts.groupBy("key", "kind").agg(one.alias("times"), F.first(F.struct(*parts.columns[2:])).alias("part")).select("key", "kind", "times", "part.*"), "kinds")
        keys = kinds.groupBy("key").agg(one.alias("kinds"), F.count_if(F.col("times") == 1).alias("single"), F.sum(F.octet_length("piece")).alias("bytes"))
        wanted = keys.where("single > 0 AND kinds > 1").select("key", (F.col("bytes") > rule.group_bytes).alias("large"))
        more = materialize(kinds.join(wanted, "key"), "wanted")
        again = parts.join(kinds.where("times > 1").select("key", "kind"), ["key", "kind"], "left_semi").select("of_key", "of_kind", F.col("shift").alias("low"), (F.col("shift") + F.col("windows")).alias("high"))
        few = more.where("NOT large")
        sorted_few = _ordered(few.select("key", "kind", "piece", "anchor"), rule).join(few.select("key", "kind", "of_key", "of_kind", "shift"), ["key", "kind"])
        rows = again.unionByName(sorted_few.select("of_key", "of_kind", (F.col("shift") + F.col("low")).alias("low"), (F.col("shift") + F.col("high")).alias("high")))
        out = rows if out is None else out.unionByName(rows)
        parts = more.where("large").select(*parts.columns)
    out = out if out is not None else parts.select("of_key", "of_kind", F.col("shift").alias("low"), F.col("windows").alias("high"))
    return out.select(F.col("of_key").alias("key"), F.col("of_kind").alias("kind"), "low", "high")


def repeated_spans(docs: DataFrame, rule: Repeats = Repeats()) -> DataFrame:
    """(id, spans): for each distinct text with repeats, (low, high) of its repeated bytes, not merged. ``docs`` has ``id``, which equal texts share, and ``text`` (binary)."""
    ship(docs.sparkSession)
    segments = materialize(_segments(docs, rule), "segments")
    one = F.count(F.lit(1))
    # Where a kind occurs once, the least of its places is its place.
    kinds = materialize(segments.groupBy("key", "kind").agg(one.alias("times"), F.min(F.struct("id", "start")).alias("at"), F.max("windows").alias("windows"), F.max("again").alias("again")), "kinds")
    size = F.sum(F.col("windows") + (rule.length - 1))
    keys = kinds.groupBy("key").agg(one.alias("kinds"), F.count_if(F.col("times") == 1).alias("single"), F.max("again").alias("again"), size.alias("bytes"))
    wanted = materialize(keys.where("single > 0 AND (kinds > 1 OR again)").select("key", (F.col("bytes") > rule.group_bytes).alias("large")), "anchors")
    pieces = materialize(_bytes_of(docs, wanted, rule).join(wanted, "key"), "pieces")
    found = _ordered(pieces.where("NOT large").drop("large"), rule).unionByName(_divided(pieces.where("large").drop("large"), rule))
    single = kinds.where("times = 1").select("key", "kind", "at")
    last = rule.length - 1
    parts = found.join(single, ["key", "kind"]).select("at.id", (F.col("at.start") + F.col("low")).alias("low"), (F.col("at.start") + F.col("high") + last).alias("high"))
    whole = segments.join(kinds.where("times > 1").select("key", "kind"), ["key", "kind"], "left_semi").select("id", F.col("start").alias("low"), (F.col("start") + F.col("windows") + last).alias("high"))
    # Copies of a text have the same spans; a text has no more than its segments' windows.
    return parts.unionByName(whole).groupBy("id").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Rows of (low, high) in order, overlapping and touching ones as one."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    leads = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    first = np.flatnonzero(leads)
    return np.stack([spans[first, 0], reach[np.concatenate([first[1:] - 1, [len(spans) - 1]])]], axis=1)


def remove_repeats(docs: DataFrame, rule: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed runs: low, high) and kept (the bytes that are left) of every row of ``docs``.

    Texts are UTF-8 bytes, and null is empty. What is removed is decided on the
    input alone, so of copies none stays. Texts shorter than a repeat stay.
    Rows that repeat, with or without a doc_id, are copies of each other; a text
    that repeats a string within itself loses all its places. Texts may be of
    any length. Other columns are not read. Empty tables give no rows.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("id"), body.alias("text"))
    spans = repeated_spans(rows, rule)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists, sizes, runs, left = batch["text"], batch["spans"], [], [], []
            for k in range(batch.num_rows):
                raw = texts[k].as_py()
                sizes.append(len(raw))
                if not lists[k].is_valid:
                    runs.append([])
                    left.append(raw)
                    continue
                flat = lists[k].values
                out = merged(np.stack([flat.field(0).to_numpy(), flat.field(1).to_numpy()], axis=1)).tolist()
                runs.append([{"low": a, "high": b} for a, b in out])
                edges = [0, *(x for run in out for x in run), len(raw)]
                left.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            yield pa.record_batch([batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(runs, span), pa.array(left, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.join(spans, "id", "left").select("doc_id", "text", "spans").mapInArrow(cut, f"doc_id {kind}, n_bytes long, spans array<struct<low:long,high:long>>, kept binary")


def repeat_report(docs: DataFrame, rule: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row; see ``remove_repeats``."""
    out = remove_repeats(docs, rule)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
