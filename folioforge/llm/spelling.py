"""Spelling variants: words that differ by one letter, through a dictionary of pairs of trie nodes.

Every prefix of a word is a node of the trie of all words, every suffix a node
of the trie of all reversed words; nodes have numbers. A word without the letter
at i is the pair (node of what precedes i, node of what follows i); a word split
at i is a pair of the same kind. Words whose pairs are equal across a skipped
position each differ by a replaced letter; where the pair of a skipped position
is the split of another word, that word lacks the letter. Equal pairs mean equal
letters on both sides, so what is found is exact and nothing has to be compared.

A pair is shared by as many words as there are letters, at most, so no group of
the joins grows with the vocabulary. Nodes near the roots, which most words
share, are numbered by their letters; only deeper ones need the dictionary.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize

#: Fixed value: what a word is made of.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Nodes of up to so many letters are numbered by them: code points are below 2**21, so three fit into a long.
SHORT = 3


@dataclass(frozen=True)
class Spelling:
    """Words of ``letters`` code points or more that occur ``occurrences`` times or more; a form is ``ratio`` times as frequent as its variant, or more."""

    letters: int = 6
    occurrences: int = 5
    ratio: int = 5


def runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """(doc_id, run): every maximal run of letters of every whole text that has ``least`` letters or more, A-Z in lower case."""
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col("text"), F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= least)
    # Most runs are ASCII, for which Spark's own lower case does the same and costs far less.
    lowered = F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(F.translate("run", UPPER, LOWER))
    return found.select("doc_id", lowered.alias("run"))


def misspelled(found: DataFrame, every: int = 199) -> DataFrame:
    """The ``word`` of each (doc_id, run): the run, or, where ``every`` divides h, the CRC-32 of ``<doc_id>:<run>``, the run without its code point number h modulo length."""
    hashed = found.select("run", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """(word, n) of the words that are long and frequent enough. Spark counts in each task first, so a hot word costs one row per task."""
    counted = words.where(F.length("word") >= rule.letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= rule.occurrences)


def _short_number(part: Column) -> Column:
    """Letters as digits, below zero so that they differ from the dictionary's numbers."""
    number = F.lit(0).cast("long")
    for k in range(1, SHORT + 1):
        number = F.when(F.length(part) >= k, F.shiftleft(number, 21) + F.ascii(F.substring(part, k, 1)) + 1).otherwise(number)
    return -number - 1


def _nodes(pairs: DataFrame, side: str) -> DataFrame:
    """``pairs`` with the strings in ``side`` replaced by the numbers of their nodes."""
    rest = [c for c in pairs.columns if c != side]
    deep = F.length(side) > SHORT
    # Written once, so that numbers stay what they are when a task runs again.
    numbers = materialize(pairs.where(deep).select(side).distinct().withColumn("number", F.monotonically_increasing_id()), "trie")
    far = pairs.where(deep).join(numbers, side).select(*rest, F.col("number").alias(side))
    return pairs.where(~deep).select(*rest, _short_number(F.col(side)).alias(side)).unionByName(far)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of words, in both directions, that one inserted, deleted or replaced code point tells apart.

    ``words`` has distinct words in ``word`` and their counts in ``n``.
    """
    size = F.length("word")
    numbered = materialize(words.select("word", "n"), "words")

    def cut(skip: int) -> Column:
        # Positions from 0; without a letter there is one split more than there are letters.
        return F.transform(F.sequence(F.lit(0), size - skip), lambda i: F.struct(F.lit(bool(skip)).alias("skips"), F.substring("word", F.lit(1), i).alias("before"), F.substring(F.col("word"), i + 1 + skip, size).alias("after"), (F.substring(F.col("word"), i + 1, F.lit(1)) != F.when(i > 0, F.substring(F.col("word"), i, F.lit(1))).otherwise(F.lit(""))).alias("leads")))

    cuts = materialize(numbered.select("word", "n", F.explode(F.concat(cut(1), cut(0))).alias("c")).select("word", "n", "c.*"), "cuts")
    pairs = materialize(_nodes(_nodes(cuts, "before"), "after"), "pairs")
    mine = pairs.where("skips").select("before", "after", "word", "n", "leads")
    replaced = mine.drop("leads", "n").join(mine.select("before", "after", F.col("word").alias("near"), F.col("n").alias("near_n")), ["before", "after"]).where("word <> near").select("word", "near", "near_n")
    # Any letter of a run of equal ones may be taken for the missing one: the first of the run stands for them.
    lacks = mine.where("leads").select("before", "after", F.col("word").alias("longer"), F.col("n").alias("longer_n")).join(pairs.where("NOT skips").select("before", "after", F.col("word").alias("shorter"), F.col("n").alias("shorter_n")), ["before", "after"])
    both = F.explode(F.array(F.struct(F.col("longer").alias("word"), F.col("shorter").alias("near"), F.col("shorter_n").alias("near_n")), F.struct(F.col("shorter").alias("word"), F.col("longer").alias("near"), F.col("longer_n").alias("near_n"))))
    return replaced.unionByName(lacks.select(both.alias("x")).select("x.*"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): the end of each chain. A form is several times as frequent as its word, so chains end, and pointers that double in length reach the end in a few rounds."""
    at = materialize(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(at.join(ahead, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        at = after.select("word", "root")
        if after.where("moved").isEmpty():
            return at


def variants(words: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of the counted words; see ``spelling_report``."""
    words = materialize(words.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("neg"), "near"))
    near = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fit = -F.col("best.neg") >= F.col("n") * rule.ratio
    chosen = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fit, F.col("best.near")).alias("form"), F.when(fit, -F.col("best.neg")).alias("form_n"))
    chosen = materialize(chosen, "forms")
    return chosen.join(roots(chosen), "word").select("word", "form", "root", "n", "n_near", "form_n")


def spelling_report(docs: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the texts, after the deletions that ``misspelled`` plants.

    A word's form is its most frequent neighbour, of several the smallest in
    code-point order, if that is ``ratio`` times as frequent. Null and empty
    texts have no words; a null doc_id counts as empty text in the CRC's input
    and so may plant deletions of its own. Repeated rows count each. Texts may
    be of any length; other columns are not read. Empty tables give no rows.
    """
    # A deletion leaves no run longer than it was.
    words = misspelled(runs(docs, rule.letters))
    return variants(vocabulary(words, rule), rule)
