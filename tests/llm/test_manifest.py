import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from folioforge.llm import manifest as M
from helpers import DOCS, documents, long_text


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, arity=3):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + arity])) for i in range(0, len(levels[-1]), arity)])
    return levels


def brute(rows, arity=3):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]], arity) for g in names}
    top = tree([trees[g][-1][0] for g in names], arity)
    out = []
    for at, g in enumerate(names):
        for k, r in enumerate(groups[g]):
            tampered = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            fold, proof = leaf((*r[:4], r[4].replace("\n", ""))) if tampered else leaf(r), ""
            for levels, i in ((trees[g], k), (top, at)):
                for level in levels[:-1]:
                    run, slot = level[i - i % arity :][:arity], i % arity
                    proof += "".join(run[:slot] + run[slot + 1 :])
                    fold = digest("".join([*run[:slot], fold, *run[slot + 1 :]]))
                    i //= arity
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], digest(proof), fold, fold == top[-1][0]))
    return sorted(out, key=repr)


def rows():
    """Groups of 1 to 28 rows, a null and an empty one, ids that are null or repeat, texts that are null, empty or long."""
    out = [(100 * n + i, f"s{n}", "en" if i % 3 else None, i, f"line {i}\nend" if i % 5 else None) for n in (1, 2, 3, 4, 9, 10, 28) for i in range(n)]
    out += [(None, None, "de", 1, "a\nb"), (None, None, "de", 1, "a\nb"), (7, None, None, None, ""), (7, "", "en", 3, "\n"), (7, "", "en", 3, "\n"), (8, "ü", "ü", 2, long_text(3000) + "\n")]
    return out


def test_against_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, lang, s, n) for i, s, lang, n, t in data], DOCS).repartition(5)
    for name in ("leaf", "digest", "grp", "idx", "n", "root", "path", "kept", "part", "copy", "verified"):
        df = df.withColumn(name, F.lit("clash"))
    got = sorted(map(tuple, M.tamper_report(df).collect()), key=repr)
    assert got == brute(data)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("arity", (2, 5))
def test_other_arities_and_groups(spark, arity):
    data = rows()
    df = spark.createDataFrame([(i, t, lang, s, n) for i, s, lang, n, t in data], DOCS)
    made = M.manifest(df, {"doc_id": F.col("doc_id")}, arity=arity)
    got = made.leaves.select("doc_id", F.lower(F.hex("leaf")).alias("leaf"), M.proof_digest(F.col("path")).alias("proof"), M.fold(F.col("leaf"), F.col("path")).alias("root")).collect()
    want = brute(data, arity)
    assert sorted((r["doc_id"], r["leaf"], r["proof"]) for r in got if r["doc_id"] is not None) == sorted((r[0], r[1], r[4]) for r in want if r[0] is not None)
    assert {r["root"] for r in got} == {made.root} == {r[3] for r in want}
    groups = {r["group"]: (r["rows"], r["subroot"].hex()) for r in made.groups.collect()}
    assert len(groups) == 10 and groups["s28"][0] == 28 and groups[None][0] == 3 and groups[""][0] == 2
    with pytest.raises(ValueError):
        M.manifest(df, {}, arity=1)


def test_one_row_and_none(spark):
    one = [(1, "s", "en", 1, "a")]
    df = documents(spark, [(1, "a")])
    assert sorted(map(tuple, M.tamper_report(df).collect())) == brute(one)
    assert M.tamper_report(df.where("false")).collect() == []
