"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all training documents. The model is trained by
follow-the-regularised-leader with elastic-net penalties on a bounded sample,
and its temperature is calibrated on sampled training documents that it has not
seen. Every text is read whole, when training and when predicting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import ship
from folioforge.llm.ftrl import Penalties, fit_multinomial, fit_temperature, softmax

#: Features: n-grams of 1 to 3 characters, hashed.
BITS = 16
#: Documents that the classifier is fitted on, at most, on average: an equal part for each language. A quarter calibrates.
FIT_DOCS = 2400
#: Languages that are learned, at most: those with most rows.
LANGUAGES = 256
#: Characters looked at together.
BLOCK_CHARS = 1 << 20
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, counts) of the whole text; none if it has no letters.

    Letters are lower-cased; what lies between words counts as one space.
    """
    total = np.zeros(1 << BITS, np.int64)
    last = np.array([32], np.uint32)
    seen = False
    text = text or ""
    for start in range(0, len(text), BLOCK_CHARS):
        codes = np.frombuffer(text[start : start + BLOCK_CHARS].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(_letters()[codes], codes, np.uint32(32))
        seen = seen or bool((codes != 32).any())
        codes = np.concatenate([last, codes])
        space = codes == 32
        codes = codes[~(space & np.concatenate([[False], space[:-1]]))]
        if start + BLOCK_CHARS >= len(text) and codes[-1] != 32:
            codes = np.append(codes, np.uint32(32))
        # The first two codes of a later block have been counted with the block before.
        old = len(last) if start else 0
        one = codes * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ codes[1:]) * np.uint32(0x85EBCA6B)
        two ^= two >> np.uint32(15)
        three = (two[:-1] ^ codes[2:]) * np.uint32(0xC2B2AE35)
        parts = (one[old:] * np.uint32(0x27D4EB2F), two[max(0, old - 1) :] * np.uint32(0x165667B1), three[max(0, old - 2) :])
        total += np.bincount(np.concatenate(parts) >> np.uint32(32 - BITS), minlength=1 << BITS)
        last = codes[-2:]
    if not seen:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        at, x = tf_idf(at, counts, self.idf)
        return x @ self.weights[at]


def tf_idf(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (1 + np.log(counts)) * idf[at]
    keep = x > 0
    at, x = at[keep], x[keep]
    return at, x / max(float(np.sqrt((x * x).sum())), 1e-12)


def held_out() -> Column:
    """Whether crc32(doc_id as text) mod 5 is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts hold each feature, and how many texts have letters; over all rows.

    Each task adds up its own texts; the sum has one row per feature.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                at, _ = ngram_counts(text.as_py())
                df[at] += 1
                n += bool(len(at))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1], pa.int32()), pa.array([*df[at].tolist(), n], pa.int64())], names=["feature", "n"])

    out, total = np.zeros(1 << BITS, np.int64), 0
    for row in docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toLocalIterator():
        if row["feature"] < 0:
            total = row["n"]
        else:
            out[row["feature"]] = row["n"]
    return out, total


def sample_features(docs: DataFrame, fit_docs: int) -> list:
    """(lang, features, counts, calibrate) of a sample of the rows, an equal part for each language.

    A row is in or out by a hash of its id, with a chance that its language's number of rows sets.
    Languages are the ``LANGUAGES`` most frequent ones at most; a model has weights for each.
    """
    lang = F.col("lang").cast("string").alias("lang")
    counts = docs.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return []
    share = max(1, fit_docs // len(counts))
    # A literal, not a table of local rows: those pass through Python workers of a kind of their own, which stay beside the others.
    chances = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], share / r["n"])])
    u = lambda salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 20)) / float(1 << 20)
    chosen = docs.select("doc_id", "text", lang).where(u("fit") < chances[F.col("lang")]).select("lang", "text", (u("calibrate") < 0.25).alias("calibrate"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_counts(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([a.astype("<u2").tobytes() for a, _ in found], pa.binary()), pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary())], names=["lang", "calibrate", "at", "counts"])

    rows = chosen.mapInArrow(run, "lang string, calibrate boolean, at binary, counts binary").collect()
    # Tasks end in any order: the training order must not depend on it.
    return sorted(((r["lang"], np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<u4").astype(np.float64), r["calibrate"]) for r in rows if r["at"]), key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, penalties: Penalties | None = None) -> Model:
    """Learn from text and non-null lang of ``docs``; without any, the model knows no language."""
    penalties = penalties or Penalties(alpha=0.5, l1=0.05, l2=0.1)
    docs = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL")
    df, n = document_frequencies(docs)
    idf = np.where(df > 0, np.log((1 + n) / (1 + df)) + 1, 0.0)
    rows = sample_features(docs, fit_docs)
    languages = sorted({r[0] for r in rows})
    code = {lang: k for k, lang in enumerate(languages)}
    if not rows:
        return Model([], idf, np.zeros((1 << BITS, 0)), 1.0)
    fitted = [r for r in rows if not r[3]] or rows
    weights = fit_multinomial([tf_idf(a, c, idf) for _, a, c, _ in fitted], np.array([code[r[0]] for r in fitted]), 1 << BITS, len(languages), penalties)
    model = Model(languages, idf, weights, 1.0)
    back = [r for r in rows if r[3]]
    if back:
        model.temperature = fit_temperature(np.stack([model.logits(a, c) for _, a, c, _ in back]), np.array([code[r[0]] for r in back]))
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its text alone."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS rows of at most LANGUAGES: its size does not grow with the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1):
                at, counts = ngram_counts(text.as_py())
                if not len(at) or not m.languages:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                q = softmax(m.logits(at, counts) / m.temperature)
                best = int(q.argmax())
                langs.append(m.languages[best])
                scores.append(float(q[best]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    The model learns from rows that are not held out and have a lang. Text that
    is null, empty or without letters is ``und`` with score 0, as is every text
    when there is nothing to learn from. Repeated rows get the same answer each;
    of equal probabilities the first language in the order of their names is
    predicted. An empty table gives an empty one; very long texts are read
    whole; other columns, whatever their names, are not read.
    """
    return predict(docs, fit(docs.where(~held_out()), fit_docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.5, fit_docs: int = FIT_DOCS) -> DataFrame:
    """The rows whose language is known with ``min_score`` or more, with their own columns."""
    model = fit(docs.where(~held_out()), fit_docs)
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            keep = []
            for text in batch.column(at_text):
                at, counts = ngram_counts(text.as_py())
                keep.append(bool(len(at)) and bool(m.languages) and float(softmax(m.logits(at, counts) / m.temperature).max()) >= min_score)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
