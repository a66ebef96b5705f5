import random

import numpy as np
from pyspark.sql import functions as F

from folioforge.llm import toxicity
from helpers import documents, long_text


def data(n=600, seed=1):
    r = random.Random(seed)
    neutral = [f"word{c}{d}" for c in "abcdefgh" for d in "abcdefgh"]
    neutral = [w.replace("word", "w") for w in neutral]
    rows, labels = [], []
    for i in range(n):
        toxic, poor = r.random() < 0.2, r.random() < 0.3
        words = [r.choice(neutral) for _ in range(r.randint(10, 60))]
        if toxic:
            words += [r.choice(["idiot", "moron", "scum"]) for _ in range(2)]
        if poor:
            words += ["zzz"] * 3
        r.shuffle(words)
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(not poor), int(toxic)))
    truth = {i: ("idiot" in t or "moron" in t or "scum" in t) for i, t in rows}
    return rows, labels, truth


LABELS = "doc_id long, quality int, toxic int"


def test_unlabelled_documents_are_found_and_clean_ones_left_alone(spark):
    rows, labels, truth = data()
    rows += [(5000, None), (5001, ""), (5002, long_text(20_000)), (5003, "IDIOT, you moron"), (5003, "IDIOT, you moron"), (None, "scum idiot")]
    got = toxicity.toxic_report(documents(spark, rows, extra=True), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert np.mean([by[i]["toxic"] == truth[i] for i in range(600)]) > 0.98
    assert not any(by[i]["toxic"] for i in (5000, 5001, 5002)) and by[5003]["toxic"] and by[None]["toxic"]
    assert all(0 <= r[c] <= 1 for r in got for c in ("p_low_quality", "p_toxic", "p_toxic_low_quality"))
    both = [by[i]["p_toxic_low_quality"] for i, t in rows[:600] if truth[i] and "zzz" in t]
    assert np.mean(both) > 4 * np.mean([by[i]["p_toxic_low_quality"] for i, t in rows[:600] if not truth[i]])


def test_later_categories_use_earlier_probabilities(spark):
    rows, labels, _ = data()
    chain = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, LABELS), toxicity.categories(), "toxic")
    assert [len(w) for w in chain.chained] == [0, 1, 2]
    assert np.abs(chain.chained[2]).sum() > 0


def test_no_labels_and_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert not any(r["toxic"] for r in toxicity.toxic_report(documents(spark, [(1, "idiot")]), none).collect())
    assert toxicity.toxic_report(documents(spark, []), none).collect() == []


def test_null_labels_are_false(spark):
    labels = spark.createDataFrame([(1, None, None), (2, 0, 1), (None, 1, 1)], LABELS)
    out = toxicity.toxic_report(documents(spark, [(1, "a b"), (2, "idiot b")]), labels)
    assert out.where(F.col("p_toxic").isNull()).count() == 0


def test_the_first_category_changes_the_second(spark):
    """Toxicity follows poor quality here, which words tell only together."""
    r = random.Random(7)
    poor_words = [f"p{c}{d}" for c in "abcdefgh" for d in "abcdefgh"]
    good_words = [f"g{c}{d}" for c in "abcdefgh" for d in "abcdefgh"]
    rows, labels = [], []
    for i in range(600):
        poor = r.random() < 0.5
        rows.append((i, " ".join(r.choice(poor_words if poor else good_words) for _ in range(6))))
        labels.append((i, int(not poor), int(poor and r.random() < 0.8)))
    chain = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, LABELS), toxicity.categories(), "toxic")
    assert chain.chained[1][0] > 0.1
    sums = np.zeros((2, 3))
    sums[0, 0], sums[1, 0] = -5, 5
    low, high = chain.probabilities(sums)[:, 1]
    assert high > low
    cut = toxicity.Chain(chain.names, chain.words, chain.weights, [np.zeros(k) for k in range(3)], chain.intercepts, chain.shift)
    assert len(set(cut.probabilities(sums)[:, 1])) == 1


def test_predictions_against_brute_force(spark):
    import math

    rows, labels, _ = data(300)
    docs = documents(spark, rows)
    chain = toxicity.fit(docs, spark.createDataFrame(labels, LABELS), toxicity.categories(), "toxic")
    place = {int(h): k for k, h in enumerate(chain.words)}
    got = {r["doc_id"]: r for r in toxicity.score(docs, chain, "toxic").collect()}
    for i, text in rows[:60]:
        seen = [place[int(h)] for h in toxicity.text_features(text) if int(h) in place]
        raw = []
        for k, name in enumerate(chain.names):
            z = sum(chain.weights[f, k] for f in seen) + chain.intercepts[k] + sum(w * (2 * p - 1) for w, p in zip(chain.chained[k], raw, strict=True))
            raw.append(1 / (1 + math.exp(-z)))
            assert abs(got[i][f"p_{name}"] - 1 / (1 + math.exp(-z - chain.shift[k]))) < 1e-9
        assert got[i]["toxic"] == (got[i]["p_toxic"] >= 0.65)


def test_probabilities_are_those_of_the_labels_not_of_the_sample(spark):
    """Words say nothing here: probabilities are how often the labels hold each category."""
    r = random.Random(3)
    rows = [(i, " ".join(r.choice("abcdef") for _ in range(5))) for i in range(4000)]
    labels = [(i, int(r.random() < 0.7), int(r.random() < 0.05)) for i, _ in rows]
    out = toxicity.toxic_report(documents(spark, rows), spark.createDataFrame(labels, LABELS), fit_docs=600)
    mean = out.agg(F.avg("p_low_quality"), F.avg("p_toxic"), F.avg("p_toxic_low_quality")).first()
    assert abs(mean[0] - 0.3) < 0.08 and abs(mean[1] - 0.05) < 0.03 and abs(mean[2] - 0.015) < 0.015
