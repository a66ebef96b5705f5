"""Toxicity by classifier chains.

Categories are predicted one after the other. Each category has a linear model
over the words and word beginnings of the whole text and over the probabilities of the categories
before it; these are out-of-fold predictions when training, so that a later
model learns from probabilities as good, or bad, as those it will meet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import ship
from folioforge.llm.ftrl import Penalties, fit_binary

#: Labelled documents that the chain is fitted on, at most, on average: half of them toxic, if there are as many.
FIT_DOCS = 4000
FOLDS = 3
#: Distinct words whose features a Python worker keeps.
WORD_TABLE = 400_000
WORD = re.compile(r"[^\W\d_]+")
#: Letters of a word's beginnings, which stand for all its inflections.
STEMS = (3, 4, 5)


def features_of(word: str) -> list[int]:
    """64-bit hashes of a lower-case word and of its beginnings."""
    return [xxhash.xxh64_intdigest(word), *[xxhash.xxh64_intdigest(word[:n] + "*") for n in STEMS if len(word) > n]]


def text_features(text: str | None) -> np.ndarray:
    """The distinct features of a whole text."""
    return np.array(sorted({h for w in set(WORD.findall((text or "").lower())) for h in features_of(w)}), np.uint64)


@dataclass
class Chain:
    """``words``: sorted hashes of the features with weight; ``weights``: (words, categories); ``chained[k]``: weights of the probabilities of categories before k.

    ``shift`` has the log-odds between the sample, which the models and the
    probabilities that they hand on are about, and the labels.
    """

    names: list[str]
    words: np.ndarray
    weights: np.ndarray
    chained: list[np.ndarray]
    intercepts: np.ndarray
    shift: np.ndarray

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """From the sums of word weights, (rows, categories), in the order of the chain."""
        z = np.zeros_like(sums)
        for k in range(len(self.names)):
            z[:, k] = sums[:, k] + self.intercepts[k] + (_scaled(_logistic(z[:, :k])) @ self.chained[k] if k else 0)
        return _logistic(z + self.shift)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _scaled(p: np.ndarray) -> np.ndarray:
    """Probabilities as features from -1 to 1."""
    return 2 * p - 1


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], balance: str, fit_docs: int = FIT_DOCS, penalties: Penalties | None = None) -> Chain:
    """Learn from the documents that ``labels`` (doc_id and what ``categories`` refer to) covers.

    ``categories`` maps names to boolean columns, in the chain's order; null is
    false. Rows are sampled by a hash of their id, equally many with and without
    category ``balance``; the chain's ``shift`` undoes that for each category.
    Rows without id are not learned from; of rows that repeat an id a category
    holds if it does for one. Without labelled texts every probability is 0.
    """
    ship(docs.sparkSession)
    penalties = penalties or Penalties(alpha=1.0, l1=5.0, l2=0.1, epochs=8)
    names = list(categories)
    flags = labels.where("doc_id IS NOT NULL").select("doc_id", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in categories.items()])
    flags = flags.groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names])
    # At most two to the number of categories.
    together = flags.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {b: sum(r["n"] for r in together if r[balance] == b) for b in (True, False)}
    part = fit_docs / 2
    chance = F.when(F.col(balance), F.lit(part / max(1, sizes.get(True, 0)))).otherwise(F.lit(part / max(1, sizes.get(False, 0))))
    chosen = flags.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20) < chance)
    rows = docs.select("doc_id", "text").join(_checked_broadcast(chosen, 4 * fit_docs), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array([text_features(t.as_py()).astype("<u8").tobytes() for t in batch.column(1)], pa.binary())], names=["doc_id", *names, "words"])

    schema = "doc_id long, " + ", ".join(f"`{n}` boolean" for n in names) + ", words binary"
    found = sorted(rows.select(F.col("doc_id").cast("long"), "text", *names).mapInArrow(run, schema).collect(), key=lambda r: (r["doc_id"], bytes(r["words"])))
    sets = [np.frombuffer(r["words"], "<u8") for r in found]
    if not sets:
        return Chain(names, np.empty(0, np.uint64), np.zeros((0, len(names))), [np.zeros(k) for k in range(len(names))], np.full(len(names), -35.0), np.zeros(len(names)))
    # Features of a single sampled document carry no evidence.
    vocabulary, counts = np.unique(np.concatenate(sets), return_counts=True)
    vocabulary = vocabulary[counts > 1]
    v = len(vocabulary)
    at = []
    for s in sets:
        k = np.searchsorted(vocabulary, s)
        s, k = s[k < v], k[k < v]
        at.append(k[vocabulary[k] == s])
    y = {n: np.array([bool(r[n]) for r in found], float) for n in names}
    fold = np.array([xxhash.xxh64_intdigest(str(r["doc_id"])) % FOLDS for r in found])
    earlier = np.zeros((len(sets), 0))
    weights, chained, intercepts = np.zeros((v, len(names))), [], np.zeros(len(names))

    def data(k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        extra = np.arange(v, v + k + 1)
        return [(np.concatenate([a, extra]), np.concatenate([np.ones(len(a)), [1.0], _scaled(earlier[i])])) for i, a in enumerate(at)]

    def score(w: np.ndarray, row: tuple[np.ndarray, np.ndarray]) -> float:
        return 1 / (1 + np.exp(-np.clip(w[row[0]] @ row[1], -35, 35)))

    for k, n in enumerate(names):
        rows_k = data(k)
        w = fit_binary(rows_k, y[n], v + k + 1, penalties)
        weights[:, k], intercepts[k], w_chain = w[:v], w[v], w[v + 1 :]
        chained.append(w_chain)
        if k + 1 < len(names):
            oof = np.zeros(len(sets))
            for f in range(FOLDS):
                train = np.flatnonzero(fold != f)
                part_w = fit_binary([rows_k[i] for i in train], y[n][train], v + k + 1, penalties) if len(train) else np.zeros(v + k + 1)
                for i in np.flatnonzero(fold == f):
                    oof[i] = score(part_w, rows_k[i])
            earlier = np.concatenate([earlier, oof[:, None]], axis=1)
    used = np.flatnonzero(np.abs(weights).sum(axis=1) > 0)
    return Chain(names, vocabulary[used], weights[used], chained, intercepts, np.array([_shift(together, n, balance, sizes, part) for n in names]))


def _shift(together: list, name: str, balance: str, sizes: dict[bool, int], part: float) -> float:
    """How much smaller the log-odds of a category are in the labels than in the sample, by how its rows were drawn."""
    drawn = {b: min(1.0, part / max(1, n)) for b, n in sizes.items()}
    rows, sampled = ({b: sum(r["n"] * weight[r[balance]] for r in together if r[name] == b) for b in (True, False)} for weight in ({True: 1.0, False: 1.0}, drawn))
    if min(*rows.values(), *sampled.values()) <= 0:
        return 0.0
    return float(np.log(rows[True] / rows[False]) - np.log(sampled[True] / sampled[False]))


def _checked_broadcast(df: DataFrame, most: int) -> DataFrame:
    """Broadcast a side whose rows have been counted; beyond ``most`` Spark shuffles it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def score(docs: DataFrame, chain: Chain, flag: str, threshold: float = 0.65) -> DataFrame:
    """doc_id, p_<category> for each category, and ``flag`` as boolean, of every row's whole text.

    Null and empty texts have no words: they get the intercepts' probabilities
    and are never flagged. Repeated rows get the same answer each, and a
    probability equal to the threshold flags. An empty table gives an empty one.
    Other columns, whatever their names, are not read.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(chain)  # words of a bounded sample
    names = chain.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = held.value
        place = {int(h): k for k, h in enumerate(c.words)}
        known: dict[str, tuple[int, ...]] = {}  # word to its features that have weight
        for batch in batches:
            sums, any_word = np.zeros((batch.num_rows, len(names))), []
            for i, text in enumerate(batch.column(1)):
                words = set(WORD.findall((text.as_py() or "").lower()))
                any_word.append(bool(words))
                held_here: set[int] = set()
                for w in words:
                    at = known.get(w)
                    if at is None:
                        if len(known) >= WORD_TABLE:
                            known.clear()
                        at = known[w] = tuple(place[h] for h in features_of(w) if h in place)
                    if at:
                        held_here.update(at)
                if held_here:
                    sums[i] = c.weights[sorted(held_here)].sum(axis=0)
            p = c.probabilities(sums)
            hit = (p[:, names.index(flag)] >= threshold) & np.array(any_word, bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p[:, k], pa.float64()) for k in range(len(names))], pa.array(hit, pa.bool_())], names=["doc_id", *[f"p_{n}" for n in names], flag])

    schema = "doc_id long, " + ", ".join(f"`p_{n}` double" for n in names) + f", `{flag}` boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def categories() -> dict[str, Column]:
    """The chain of the given labels: poor texts, toxic ones, and those that are both."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1, "toxic_low_quality": (F.col("quality") == 0) & (F.col("toxic") == 1)}


def toxic_report(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """Fit the chain on ``labels`` and score all of ``docs``: doc_id, p_<category> for each category, toxic.

    Null and empty texts have no words and are never flagged; long ones are
    scored whole. Repeated rows get the same answer each; a probability equal to
    the threshold flags. Rows without id are scored, not learned from. Other
    columns, whatever their names, are not read. Without labelled texts every
    probability is 0; an empty table gives an empty one.
    """
    return score(docs, fit(docs, labels, categories(), "toxic", fit_docs), "toxic")
