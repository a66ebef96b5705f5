"""Small tables and brute-force versions."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=False):
    """Rows of (doc_id, text[, lang[, source]]); with ``extra``, columns whose names operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS).repartition(3)
    if extra:
        for name in ("digest", "key", "shard", "kept", "score", "bands", "base", "spans", "comp", "block", "old", "n", "weight", "vec", "rank"):
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("clash"))
    return df


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def near_components(rows, k, percent):
    """doc_id to (set size, smallest id reachable), by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                p, q = top(a), top(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), top(i)) for i in ids}


def near_copies(seed=5, group=120, others=80, words=120):
    """A group of copies with few to many edits, and short strangers."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    base = [r.choice(vocabulary) for _ in range(words)]
    rows = []
    for i in range(group):
        w = list(base)
        for _ in range(int(r.expovariate(1 / 5))):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((i, "  ".join(w)))
    rows += [(group + i, "\t".join(r.choice(vocabulary) for _ in range(r.randint(0, 25)))) for i in range(others)]
    return rows


def long_text(words=60_000):
    r = random.Random(1)
    return " ".join(r.choice(["alpha", "beta", "gamma", "delta", "Über", "été"]) for _ in range(words))
