import hashlib
import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

from folioforge.llm import bpe  # noqa: E402
from helpers import documents, long_text  # noqa: E402

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "aeiou th's ", "".join(map(chr, range(1, 0x250))), "ΣσςİıſKÅ'\x85\x1c\xa0　é​", "日本語한국어ابجدहिन्दी😀", "aab", "0123456789½²", "<|endoftext|> ab"]


def test_same_ids_and_text_as_the_library(reference):
    a, r = bpe.automaton(PATH), random.Random(2)
    for k in range(4000):
        alphabet = r.choice(ALPHABETS)
        s = "".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) + ("<|endoftext|>X" if k % 7 == 0 else "")
        want = reference.encode(s, add_special_tokens=False).ids
        assert a.encode(s) == want, repr(s)
        assert a.decode(want) == reference.decode(want, skip_special_tokens=False)


def test_merge_gadgets_of_a_small_vocabulary():
    """All words over two letters, against merging by rank."""
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "b"), ("ab", "aab"), ("bb", "a")]
    tokens = ["a", "b", *["".join(m) for m in merges]]
    a = bpe.TokenAutomaton({"model": {"vocab": {t: i for i, t in enumerate(tokens)}, "merges": [" ".join(m) for m in merges]}, "added_tokens": []})

    def by_rank(word):
        parts = list(word)
        while True:
            ranked = [(merges.index((x, y)), i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if (x, y) in merges]
            if not ranked:
                return parts
            _, i = min(ranked)
            parts[i : i + 2] = ["".join(parts[i : i + 2])]

    for n in range(1, 11):
        for bits in range(1 << n):
            word = "".join("ab"[bits >> k & 1] for k in range(n))
            assert [tokens[i] for i in a.encode_symbols(word)] == by_rank(word), word


def literal_gadgets(base, merges):
    """States as dicts of arcs, changed one merge after the other just as the construction says."""
    states = [{x: 0 for x in base}]
    for a, b in merges:
        found = {arcs[a] for arcs in states if a in arcs}
        if not found:
            continue
        (q,) = found
        if b not in states[q]:
            continue  # such neighbours are never there
        r = states[q][b]
        states.append({x: t for x, t in states[q].items() if x != b})
        for arcs in states:
            if a in arcs:
                arcs[a], arcs[a + b] = len(states) - 1, r
    return states


@pytest.mark.parametrize("seed", range(60))
def test_compiled_table_has_the_arcs_of_the_gadgets(seed):
    r = random.Random(seed)
    base = "abc"[: r.randint(1, 3)]
    tokens, merges = list(base), []
    for _ in range(r.randint(1, 14)):
        a, b = r.choice(tokens), r.choice(tokens)
        if (a, b) not in merges and a + b not in tokens:
            merges.append((a, b))
            tokens.append(a + b)
    a = bpe.TokenAutomaton({"model": {"vocab": {t: i for i, t in enumerate(tokens)}, "merges": [" ".join(m) for m in merges]}, "added_tokens": []})
    states = literal_gadgets(base, merges)
    for x, last in enumerate(tokens):
        leads = {arcs[last] for arcs in states if last in arcs}
        if not leads:
            assert x not in a.target  # nothing ever makes this label
            continue
        (state,) = leads
        assert {tokens[y] for y in a.target if a.arc(x, y)} == set(states[state]), last
    assert a.n_states <= len(merges) + 1


def test_files_that_ask_for_more_are_refused(tmp_path):
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    assert bpe.unsupported(spec) == []
    assert bpe.unsupported(spec | {"decoder": {"type": "ByteLevel"}, "normalizer": None}) == ["normalizer", "decoder"]
    assert bpe.unsupported(spec | {"model": spec["model"] | {"ignore_merges": True}}) == ["model.ignore_merges"]
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec | {"pre_tokenizer": None}))
    with pytest.raises(ValueError, match="pre_tokenizer"):
        bpe.automaton(str(other))


def test_long_words_take_linear_time(reference):
    text = "ab" * 20_000
    assert bpe.automaton(PATH).encode(text) == reference.encode(text, add_special_tokens=False).ids


def test_encode_decode_and_digests(spark, reference):
    rows = [(1, "Hello, World"), (2, None), (3, ""), (4, " \n "), (5, long_text(5000)), (1, "Hello, World"), (None, "x")]
    docs = documents(spark, rows, extra=True)
    got = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert got.columns == [*docs.columns, "token_ids", "decoded"]
    want = {t or "": reference.encode(t or "", add_special_tokens=False).ids for _, t in rows}
    back = got.collect()
    assert len(back) == len(rows)
    for r in back:
        assert r["token_ids"] == want[r["text"] or ""]
        assert r["decoded"] == reference.decode(r["token_ids"], skip_special_tokens=False)
    for r in bpe.digests(docs, PATH).collect():
        text = dict(rows)[r["doc_id"]] or ""
        assert r["n_tokens"] == len(want[text])
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, want[text])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(reference.decode(want[text], skip_special_tokens=False).encode()).hexdigest()


def test_decoding_in_the_same_pass(spark, reference):
    rows = [(1, "Ünïcode words, 12 of them"), (2, None), (3, ""), (4, "ab " * 30_000), (4, "ab " * 30_000), (None, "x 😀 y")]
    docs = documents(spark, rows).withColumn("decoded", F.lit("clash")).withColumn("token_ids", F.lit("clash"))
    one = bpe.encode(docs, PATH, decoded_col="decoded")
    two = bpe.decode(bpe.encode(docs.drop("decoded"), PATH), PATH)
    assert one.columns == two.columns
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
    assert bpe.encode(documents(spark, []), PATH, decoded_col="decoded").collect() == []


def test_empty_table(spark):
    docs = documents(spark, [])
    assert bpe.encode(docs, PATH).count() == 0 == bpe.digests(docs, PATH).count()


def test_null_and_unknown_ids(spark):
    df = spark.createDataFrame([([320, 10**6],), (None,), ([],)], "token_ids array<int>")
    assert [r["decoded"] for r in bpe.decode(df, PATH).collect()] == ["a</w>", "", ""]
