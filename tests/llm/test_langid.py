import zlib

import numpy as np

from folioforge.llm import ftrl, langid
from helpers import documents, long_text

WORDS = {"en": "the of and to in that it is was for on are as with his they at be this have from".split(), "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(), "fr": "de la le et les des en un du une que est pour qui dans à par plus pas au sur".split()}


def corpus(n=300, seed=0):
    import random

    r = random.Random(seed)
    return [(i, " ".join(r.choice(WORDS[lang]) for _ in range(r.randint(8, 40))), lang, "s") for i in range(n) for lang in [("en", "de", "fr")[i % 3]]]


def test_held_out_accuracy_and_contract(spark):
    rows = corpus() + [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "12 34 !!", "de", "s"), (1003, "the and of", None, "s"), (1003, "the and of", None, "s"), (1004, long_text(30_000), None, "s"), (None, "der die das und nicht", "de", "s")]
    got = langid.identify(documents(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    right = [by[i]["lang_pred"] == lang for i, _, lang, _ in rows[:300] if by[i]["held_out"]]
    assert len(right) > 30 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "en", "de"]


def test_labels_of_held_out_rows_are_not_learned_from(spark):
    rows = corpus()
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s) for i, t, lang, s in rows]
    a, b = (sorted(map(tuple, langid.identify(documents(spark, x)).collect())) for x in (rows, other))
    assert a == b


def test_nothing_to_learn_from(spark):
    rows = [(i, "the and of", None, "s") for i in range(5)]
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(documents(spark, rows)).collect()} == {("und", 0.0)}
    assert langid.identify(documents(spark, [])).collect() == []


def test_blocks_of_a_long_text_count_as_one(monkeypatch):
    text = "Été! 12 the quick  brown\nfox. " * 50 + "end"
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "BLOCK_CHARS", 7)
    parts = langid.ngram_counts(text)
    assert [x.tolist() for x in whole] == [x.tolist() for x in parts]


def test_stage_keeps_columns_and_clean_rows(spark):
    docs = documents(spark, corpus() + [(1000, None), (1001, "...")], extra=True)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert not ids & {1000, 1001} and len(ids) > 295


def test_elastic_net_leaves_useless_features_at_zero():
    r = np.random.default_rng(0)
    rows, y = [], r.integers(0, 3, 400)
    for k in y:
        rows.append((np.array([k, 3 + r.integers(0, 50)]), np.ones(2)))
    w = ftrl.fit_multinomial(rows, y, 53, 3, ftrl.Penalties(l1=3.0))
    assert (w[:3].argmax(axis=1) == [0, 1, 2]).all() and (w[3:] == 0).mean() > 0.8


def test_temperature_cools_overconfident_logits():
    r = np.random.default_rng(1)
    y = r.integers(0, 2, 2000)
    z = np.where(np.arange(2)[None] == np.where(r.random(2000) < 0.7, y, 1 - y)[:, None], 10.0, 0.0)
    t = ftrl.fit_temperature(z, y)
    assert abs(ftrl.softmax(z / t).max(axis=1).mean() - 0.7) < 0.03


def test_predictions_against_brute_force(spark):
    """The model's formula, text by text and language by language."""
    import math

    rows = corpus(150)
    docs = documents(spark, rows)
    model = langid.fit(docs.where(~langid.held_out()))
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    for i, text, _, _ in rows[:40]:
        at, counts = langid.ngram_counts(text)
        x = {int(f): (1 + math.log(c)) * model.idf[f] for f, c in zip(at, counts, strict=True)}
        length = math.sqrt(sum(v * v for v in x.values()))
        z = [sum(v / length * model.weights[f, k] for f, v in x.items()) / model.temperature for k in range(len(model.languages))]
        q = [math.exp(v - max(z)) for v in z]
        best = max(range(len(z)), key=lambda k: z[k])
        assert got[i]["lang_pred"] == model.languages[best]
        assert abs(got[i]["score"] - q[best] / sum(q)) < 1e-6


def test_a_dirty_lang_column_keeps_the_most_frequent_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    rows = corpus(300) + [(1000 + i, "qq ww ee rr", f"junk{i}", "s") for i in range(60)]
    model = langid.fit(documents(spark, rows))
    assert model.languages == ["de", "en", "fr"]


def test_sampling_makes_no_table_of_local_rows(spark, monkeypatch):
    # Such rows pass through Python workers of a kind of their own, which stay in an executor's memory beside the others.
    docs = documents(spark, corpus(60) + [(100, "the and of", None, "s"), (None, "der die das", "de", "s")]).where("lang IS NOT NULL")

    def refuse(*args, **named):
        raise AssertionError("a table of local rows")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    rows = langid.sample_features(docs, 10_000)
    assert sorted(r[0] for r in rows) == ["de"] * 21 + ["en"] * 20 + ["fr"] * 20
