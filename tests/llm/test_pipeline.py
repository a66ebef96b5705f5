import hashlib
from collections import Counter

import pytest

pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

import corpus_pipeline as C  # noqa: E402
from folioforge.llm import langid  # noqa: E402
from helpers import documents, near_components, near_copies  # noqa: E402
from test_langid import corpus  # noqa: E402
from test_mixing import brute as mixed  # noqa: E402


def test_stages_against_brute_force(spark, tmp_path):
    rows = corpus(240)
    rows += [(4000, " ".join(rows[k % 240][1] for k in range(0, 3 * 3000, 3)), "en", "long")]
    rows += [(1000 + i, t, "en", "hot") for i, t in near_copies(group=60, others=10, words=60)]
    rows += [(2000 + i, rows[i][1], "en", "copies") for i in range(0, 60, 2)] + [(3000, None, "en", "s"), (3001, "", "de", "s"), (3002, "12 34", "fr", None)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = C.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "lang", "source", "token_ids", "n_tokens", "decoded_sha256"]

    scored = {r["doc_id"]: r for r in langid.identify(documents(spark, rows)).collect()}
    one = [r for r in rows if scored[r[0]]["lang_pred"] != "und" and scored[r[0]]["score"] >= 0.5]
    assert 3000 not in {r[0] for r in one} and len(one) > 200
    last = {}
    for r in one:
        last[r[1]] = max(last.get(r[1], -1), r[0])
    two = [r for r in one if last[r[1]] == r[0]]
    near = near_components([(r[0], r[1]) for r in two], 5, 80)
    three = [r for r in two if near[r[0]][1] == r[0]]
    assert len(three) < len(two) < len(one)
    four = mixed(three, lambda s, n: n**0.5)
    assert Counter((r["doc_id"], r["source"]) for r in got.collect()) == Counter({k: n for k, n in Counter((i, s) for i, s, _ in four.elements()).items()})

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(C.vocabulary())
    text = {r[0]: r[1] for r in rows}
    for r in got.collect():
        assert r["token_ids"] == t.encode(text[r["doc_id"]], add_special_tokens=False).ids and r["n_tokens"] == len(r["token_ids"])
        assert r["decoded_sha256"] == hashlib.sha256(t.decode(r["token_ids"], skip_special_tokens=False).encode()).hexdigest()


def test_stage_list():
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "bpe"]


def stages(spark, docs):
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, "")
    return docs


def test_rows_without_id_and_repeated_rows(spark):
    clean = corpus(90)
    docs = documents(spark, clean + [(None, clean[4][1], "en", None), (None, "der die und nicht auf mit", "de", None), clean[8], (7000, clean[9][1].upper(), "en", "s")], extra=True)
    one = C.identify_language(spark, docs, "")
    two = C.drop_exact_copies(spark, one, "")
    three = C.drop_near_copies(spark, two, "")
    assert one.columns == two.columns == three.columns == docs.columns
    texts = [r["text"] for r in two.where("doc_id IS NULL").collect()]
    assert sorted(texts) == sorted([clean[4][1], "der die und nicht auf mit"])
    assert two.where(f"doc_id = {clean[8][0]}").count() == 2
    assert {r["doc_id"] for r in three.collect()} >= {r["doc_id"] for r in two.collect()} - {7000, None} - {i for i in range(90)}
    assert three.where("doc_id = 7000").count() == 0


def test_empty_documents(spark):
    docs = stages(spark, documents(spark, []))
    assert docs.count() == 0
    assert C.tokenize(spark, docs, "").columns == ["doc_id", "lang", "source", "token_ids", "n_tokens", "decoded_sha256"]
