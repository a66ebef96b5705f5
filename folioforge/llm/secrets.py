"""Secret scanning in DataFrame functions only.

Patterns find secrets with a known shape. Beside them, candidate strings of
each character class are read through a sliding window whose Shannon entropy
is kept up to date by counts: one character enters, one leaves.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, in their order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")
ASSIGN_CHARS = 6


@dataclass(frozen=True)
class EntropyClass:
    """Candidates of one character class: runs of its characters, of at least ``window`` of them, with an entropy of ``bits`` or more in some window."""

    kind: str
    pattern: str
    hint: str
    window: int
    bits: float


#: A window of 20 holds at most log2(16) = 4 bits of hex digits and log2(20) = 4.32 of base64 characters.
#: About one in a thousand windows of uniformly random base64 characters stays below 3.5.
CLASSES = (
    EntropyClass("entropy_hex", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{20,}(?![0-9A-Za-z])", r"[0-9A-Fa-f]{20}", 20, 3.0),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_-]{20,}", r"[A-Za-z0-9+/_-]{20}", 20, 3.5),
)
PLACEHOLDER = r"(?:example|placeholder|dummy|xxxx|0123456789|abcdefgh)"
#: Candidates that match are no secrets: those without a digit or without a letter (words, numbers), UUIDs, paths of words, placeholders
#: (unless a part between slashes is as long as a window and no placeholder itself).
ALLOWED = (
    r"^[^0-9]*$",
    r"^[0-9+/_-]*$",
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"^/?([A-Za-z]+[/_-])*[A-Za-z]*[0-9]{0,4}$",
    rf"(?i)^(?=.*{PLACEHOLDER})(?!.*(?<![^/])(?![^/]*{PLACEHOLDER})[^/]{{20}})",
)


def find(text: Column, pattern: str, may: Column, kind: str) -> Column:
    """Leftmost non-overlapping matches as array of (kind, start, end, value); offsets count code points.

    The pieces between matches and the matches themselves alternate, so that
    running sums of their lengths give every offset.
    """
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    pairs = F.zip_with(pieces, matches, lambda p, m: F.struct((F.length(p) + F.length(m)).alias("n"), m.alias("match")))

    def spans(found: Column) -> Column:
        ends = running_sums(F.transform(found, lambda x: x["n"]))
        return F.zip_with(ends, found, lambda end, x: F.struct(F.lit(kind).alias("kind"), (end - F.length(x["match"])).alias("start"), end.alias("end"), x["match"].alias("value")))

    # One round of an aggregation binds the pairs to a variable, so that they are found once.
    once = F.aggregate(F.array(pairs), none, lambda _, found: spans(found))
    return F.when(may, once).otherwise(none)


def running_sums(numbers: Column) -> Column:
    """Sums up to each place of an array of int, in log2(n) passes of n steps: each adds the sum that ended 1, 2, 4, ... places before."""
    passes = F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(2)))).cast("int")
    shifts = F.transform(F.sequence(F.lit(0), passes - 1), lambda k: F.call_function("shiftleft", F.lit(1), k))

    def add(sums: Column, shift: Column) -> Column:
        return F.transform(sums, lambda x, i: x + F.when(i >= shift, F.get(sums, i - shift)).otherwise(F.lit(0)))

    return F.aggregate(shifts, numbers, add)


def _term(count: Column, most: int) -> Column:
    """count * log2(count) from a table of constants."""
    return F.element_at(F.array(*[F.lit(0.0 if c < 2 else c * log2(c)) for c in range(most + 1)]), count + 1)


def window_spans(value: Column, window: int, bits: float) -> Column:
    """(first, last): start of the first window, and end of the last, with the entropy wanted; null if there is none.

    The state holds the window's counts by character and the sum of
    c * log2(c); each step moves one character in and one out.
    """
    chars = F.split(value, "")
    entry = "map<string,int>"

    def bump(counts: Column, key: Column, by: int) -> Column:
        old = F.coalesce(F.element_at(counts, key), F.lit(0))
        rest = F.map_filter(counts, lambda k, _: k != key)
        return F.map_concat(rest, F.map_from_arrays(F.array(key), F.array(old + by)))

    def change(total: Column, old: Column, new: Column) -> Column:
        return total - _term(old, window + 1) + _term(new, window + 1)

    def count(counts: Column, key: Column) -> Column:
        return F.coalesce(F.element_at(counts, key), F.lit(0))

    def step(acc: Column, i: Column) -> Column:
        entering = F.element_at(chars, i)
        old = count(acc["counts"], entering)
        grown = F.struct(bump(acc["counts"], entering, 1).alias("counts"), change(acc["total"], old, old + 1).alias("total"))
        leaving = F.element_at(chars, F.greatest(i - window, F.lit(1)))
        # The counts after the step in, without building the map twice.
        before = F.when(leaving == entering, old + 1).otherwise(count(acc["counts"], leaving))
        full = i > window
        total = F.when(full, change(grown["total"], before, before - 1)).otherwise(grown["total"])
        counts = F.when(full, bump(grown["counts"], leaving, -1)).otherwise(grown["counts"])
        rich = (i >= window) & (F.lit(log2(window)) - total / window >= bits)
        return F.struct(counts.alias("counts"), total.alias("total"), F.when(rich & acc["first"].isNull(), i - window).otherwise(acc["first"]).alias("first"), F.when(rich, i).otherwise(acc["last"]).alias("last"))

    start = F.struct(F.create_map().cast(entry).alias("counts"), F.lit(0.0).alias("total"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the base kinds. Runs of access and hex characters are taken whole, so their length can be part of the pattern."""
    low = F.lower(text)
    words = [F.contains(low, F.lit(w)) for w in ("passw", "secret", "token", "api")]
    assign = find(text, ASSIGN, words[0] | words[1] | words[2] | words[3], "assign")
    assign = F.filter(assign, lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_CHARS)
    return {
        "assign": assign,
        "access": find(text, ACCESS, F.contains(text, F.lit("AKIA")), "access"),
        "hex": find(text, HEX, text.rlike(HEX), "hex"),
    }


def entropy_spans(text: Column, classes: tuple[EntropyClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Parts of candidate strings whose windows reach the entropy of their class."""
    found = []
    for c in classes:
        spans = find(text, c.pattern, text.rlike(c.hint), c.kind)
        spans = F.filter(spans, lambda s: ~s["value"].rlike("|".join(f"(?:{a})" for a in allowed)))
        found.append(_rich_parts(spans, c))
    return F.concat(*found)


def _rich_parts(spans: Column, c: EntropyClass) -> Column:
    rich = F.transform(spans, lambda s: F.struct(s.alias("span"), window_spans(s["value"], c.window, c.bits).alias("w")))
    rich = F.filter(rich, lambda x: x["w"]["first"].isNotNull())
    return F.transform(
        rich,
        lambda x: F.struct(
            x["span"]["kind"].alias("kind"),
            (x["span"]["start"] + x["w"]["first"]).alias("start"),
            (x["span"]["start"] + x["w"]["last"]).alias("end"),
            F.substring(x["span"]["value"], x["w"]["first"] + 1, x["w"]["last"] - x["w"]["first"]).alias("value"),
        ),
    )


def ordered(spans: Column, classes: tuple[EntropyClass, ...]) -> Column:
    """Spans by start, then kind as listed."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, *[c.kind for c in classes])])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def scan_secrets(docs: DataFrame, classes: tuple[EntropyClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Add ``base`` and ``extra``: arrays of (kind, start, end, value), by start, then kind as listed.

    ``extra`` has the entropy spans that don't lie within a base span. Null text
    counts as empty and has none. Every row stays, repeated ones too; texts are
    read whole, however long and with however many matches; an empty table gives
    an empty one; columns called base or extra are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(*base_spans(text).values())
    out = docs.withColumns({"base": ordered(base, classes), "extra": entropy_spans(text, classes, allowed)})
    inside = F.filter(F.col("extra"), lambda e: ~F.exists(F.col("base"), lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"])))
    return out.withColumn("extra", ordered(inside, classes))


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts and spans per document, derived from ``scan_secrets``.

    Null text counts as empty: counts are 0 and spans empty. Texts are scanned
    whole, however long. Every row stays, repeated ones and those without id
    too; spans that start together are ordered by kind. Other columns, whatever
    their names, are not read. An empty table gives an empty one.
    """
    found = scan_secrets(docs.select("doc_id", "text")).drop("text")
    both = ordered(F.concat("base", "extra"), CLASSES)
    return found.select(
        "doc_id",
        *[_count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"),
        joined_spans(both).alias("spans"),
    )
