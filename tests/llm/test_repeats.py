import hashlib
import random
from collections import Counter

import pytest

from folioforge.llm.repeats import Repeats, merged, remove_repeats, repeat_report
from folioforge.llm.suffix_array import suffix_array
from helpers import documents


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if times[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=repr)


def texts(seed=2):
    """Copies, copies with edits, a passage in many texts, periodic texts, and strangers."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgü") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(60), prose(150)
    rows = [(i, prose(r.randint(0, 30)) + passage + prose(r.randint(0, 30))) for i in range(40)]
    for i in range(30):
        b = list(base)
        for _ in range(r.randint(0, 3)):
            b[r.randrange(len(b))] = r.choice("xyz")
        rows.append((100 + i, "".join(b)))
    rows += [(200 + i, prose(80)) for i in range(20)]
    rows += [(300, "a" * 500), (301, "ab" * 130 + "!"), (302, "abc" * 20), (303, prose(40) * 3), (304, "ü" * 300)]
    rows += [(None, base), (None, base), (400, base), (400, base), (401, None), (402, ""), (403, "a" * 99), (404, "b" * 100), (405, "c" * 101)]
    return rows


@pytest.mark.parametrize("length,group_bytes", [(100, 1 << 17), (100, 600), (21, 1 << 17), (5, 200)])
def test_against_brute_force(spark, length, group_bytes):
    rows = texts()
    got = repeat_report(documents(spark, rows, extra=True), Repeats(length, group_bytes)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, length)


def test_long_texts_are_read_in_parts(spark):
    r = random.Random(4)
    long = "".join(r.choice("abcdefgh") for _ in range(150_000))
    rows = [(1, long), (2, long[65_000:67_000]), (3, "x" * 200_000), (4, long[:500] + "x" * 399), (5, long[-700:] + long[:100])]
    assert sorted(map(tuple, repeat_report(documents(spark, rows)).collect())) == brute(rows, 400)


def test_spans_and_bytes(spark):
    rows = [(1, "x" * 10 + "0123456789" + "y" * 3), (2, "0123456789"), (3, "none")]
    got = {r["doc_id"]: ([tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in remove_repeats(documents(spark, rows), Repeats(8)).collect()}
    assert got == {1: ([(0, 20)], b"yyy"), 2: ([(0, 10)], b""), 3: ([], b"none")}
    assert remove_repeats(documents(spark, rows).where("false")).collect() == []
    with pytest.raises(ValueError):
        Repeats(1)


def test_passages_of_many_words_below_the_length_stay(spark):
    """What counts is 400 bytes, not words: a shared passage of more than 50 words in 399 bytes is no repeat, in 400 it is."""
    r = random.Random(8)
    words = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(67))[:400]
    for size in (399, 400):
        passage = words[:size]
        rows = [(i, f"{i}{i}{i} before{i}" + passage + f"{i} after {i}{i}") for i in range(5)]
        got = sorted(map(tuple, repeat_report(documents(spark, rows)).collect()))
        assert got == brute(rows, 400)
        assert len(passage.split()) > 50 and [row[2] for row in got] == [size if size == 400 else 0] * 5


def test_merged():
    import numpy as np

    assert merged(np.array([[5, 9], [0, 3], [9, 12], [2, 4], [1, 2], [20, 21]])).tolist() == [[0, 4], [5, 12], [20, 21]]


def test_suffix_array():
    r = random.Random(1)
    for _ in range(400):
        letters, n = r.choice([1, 2, 3, 26]), r.randint(0, 60)
        text = [r.randrange(letters) for _ in range(n)]
        if r.random() < 0.3:
            text = (text[:5] or [0]) * 10
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
