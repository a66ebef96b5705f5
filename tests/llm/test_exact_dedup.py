import hashlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm.exact_dedup import PerfectHash, exact_dedup
from helpers import documents, long_text


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(min_size=32, max_size=32), max_size=300))
def test_perfect_hash(members):
    rows = np.frombuffer(b"".join(sorted(members)), np.uint8).reshape(-1, 32)
    h = PerfectHash.from_bytes(PerfectHash.build(rows).to_bytes())
    assert sorted(h.slots(rows)) == list(range(len(members)))
    strangers = np.frombuffer(b"".join(hashlib.sha256(m).digest() for m in members), np.uint8).reshape(-1, 32)
    at = h.slots(strangers)
    assert all(-1 <= x < len(members) for x in at)


def test_against_brute_force(spark):
    rows = [(i, f"text {i % 37}") for i in range(300)] + [(900, None), (901, ""), (None, "text 1"), (None, "lonely"), (None, "lonely"), (5, "text 5"), (902, long_text()), (903, long_text()), (904, "Text 1"), (905, "text 1 ")]
    got = exact_dedup(documents(spark, rows, extra=True))
    assert got.columns[:5] == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_any_history_gives_the_same(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"t{i % 7}") for i in range(50)]
    for history in (F.lit(True), F.lit(False), F.col("doc_id") < 10, F.lit(None).cast("boolean")):
        assert sorted(map(tuple, exact_dedup(documents(spark, rows), history).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).collect() == []
