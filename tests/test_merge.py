"""The merge against a plain model of the reference plan, over several runs."""

import datetime
import random

import pytest

from folioforge.operators.dedup import last_wins
from folioforge.operators.merge import distinct_from, flag_languages
from folioforge.plans.catalogue import merge_catalogue
from folioforge.plans.spec import CATALOGUE, ENTITIES
from folioforge.sources.snapshot import violations

DAY = datetime.date(2020, 1, 1)
LANGS = ["ru", "be"]


class Model:
    """Dictionaries by natural key, with local ids left out."""

    def __init__(self):
        self.entities = {n: {} for n in ("authors", "books", "genres", "sequences")}
        self.links = {n: {} for n in ("book_authors", "book_genres", "translations", "book_sequences")}
        self.payloads = {n: {} for n in ("book_annotations", "author_annotations")}

    def run(self, s, source):
        for name, table in (("authors", "staging_authors"), ("books", "staging_books"), ("genres", "staging_genres"), ("sequences", "staging_sequences")):
            for row in s[table]:
                rid, *rest = row
                if rid is None:
                    continue
                if name == "books":
                    title, lang, kind, day, gone, pages, year = rest
                    rest = [title, lang, kind, day, gone or lang not in LANGS, pages, year]
                self.entities[name][source, rid] = rest
        known = lambda name, rid: (source, rid) in self.entities[name]
        for name, other in (("book_authors", "authors"), ("book_genres", "genres"), ("translations", "authors"), ("book_sequences", "sequences")):
            wanted = {}
            for b, o, *position in s[f"staging_{name}"]:
                if known("books", b) and known(other, o):
                    wanted[(source, b), (source, o)] = [abs(p) if name == "book_sequences" else p for p in position]
            self.links[name] = {k: v for k, v in self.links[name].items() if k[0][0] != source} | wanted
        for name, owner in (("book_annotations", "books"), ("author_annotations", "authors")):
            last = {o: (title, text) for o, title, text in s[f"staging_{name}"] if o is not None and text is not None}
            for o, (title, text) in last.items():
                if known(owner, o):
                    old = self.payloads[name].get((source, o), [None, None, None])
                    self.payloads[name][source, o] = [title, text, old[2]]
            for o, file in {o: f for o, f in s[f"staging_{name[:-1]}_pics"] if o is not None}.items():
                if (source, o) in self.payloads[name]:
                    self.payloads[name][source, o][2] = file
        staged = {r[0] for r in s["staging_books"]}
        for (src, rid), row in self.entities["books"].items():
            if src == source and rid not in staged:
                row[4] = True


def snapshot(r, n=12):
    pick = lambda: r.randint(1, n)
    word = lambda: r.choice(["a", "b", "c"])
    many = lambda f, k: [f() for _ in range(k)]
    return {
        "staging_authors": many(lambda: (pick(), word(), word(), word()), n),
        "staging_books": many(lambda: (pick(), word(), r.choice(["ru", "be", "en"]), "fb2", DAY, r.random() < 0.1, r.randint(1, 3), r.randint(0, 2)), n),
        "staging_genres": many(lambda: (pick(), word(), word(), word()), n // 2),
        "staging_sequences": many(lambda: (pick(), word()), n // 2),
        "staging_book_authors": many(lambda: (pick(), pick()), 2 * n),
        "staging_book_genres": many(lambda: (pick(), pick()), n),
        "staging_translations": many(lambda: (pick(), pick(), r.randint(0, 3)), n),
        "staging_book_sequences": many(lambda: (pick(), pick(), r.randint(-3, 3)), n),
        "staging_book_annotations": many(lambda: (pick(), word(), r.choice(["x", "y", None])), n),
        "staging_book_annotation_pics": many(lambda: (pick(), word()), n // 2),
        "staging_author_annotations": many(lambda: (pick(), word(), r.choice(["x", "y", None])), n),
        "staging_author_annotation_pics": many(lambda: (pick(), word()), n // 2),
    }


def frames(spark, staged):
    out = {}
    for e in ENTITIES.values():
        schema = e.schema.add("_ord", "integer")
        names = [f.name for f in e.fields]
        assert len(names) + 1 == len(schema)
        out[e.table] = spark.createDataFrame([(*row, i) for i, row in enumerate(staged[e.table])], schema).repartition(3)
    return out


def empty(spark):
    return {n: spark.createDataFrame([], s) for n, s in CATALOGUE.items()}


def collected(spark, tables):
    rows = {n: [r.asDict() for r in tables[n].collect()] for n in CATALOGUE if n in tables}
    key = {n: {r["id"]: (r["source"], r["remote_id"]) for r in rows[n]} for n in ("authors", "books", "genres", "sequences")}
    m = Model()
    for n in m.entities:
        cols = [f.name for f in CATALOGUE[n] if f.name not in ("id", "source", "remote_id")]
        m.entities[n] = {key[n][r["id"]]: [r[c] for c in cols] for r in rows[n]}
        assert len(m.entities[n]) == len(rows[n]) == len({r["id"] for r in rows[n]})
    for n, (other, end) in {"book_authors": ("authors", "author"), "book_genres": ("genres", "genre"), "translations": ("authors", "author"), "book_sequences": ("sequences", "sequence")}.items():
        m.links[n] = {(key["books"][r["book"]], key[other][r[end]]): [r["position"]] if "position" in r else [] for r in rows[n]}
        assert len(m.links[n]) == len(rows[n])
    for n, (owner, end) in {"book_annotations": ("books", "book"), "author_annotations": ("authors", "author")}.items():
        m.payloads[n] = {key[owner][r[end]]: [r["title"], r["text"], r["file"]] for r in rows[n]}
    return m, {n: {k: i for i, k in ids.items()} for n, ids in key.items()}


def fixed(spark, merged):
    """Tables as the next run reads them."""
    out = empty(spark)
    for n, df in merged.items():
        out[n] = spark.createDataFrame([tuple(r[f.name] for f in CATALOGUE[n]) for r in df.collect()], CATALOGUE[n])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_against_the_model(spark, seed):
    r, model, tables, ids = random.Random(seed), Model(), empty(spark), {}
    for k, source in enumerate([1, 2, 1]):
        staged = snapshot(r)
        model.run(staged, source)
        tables = fixed(spark, merge_catalogue(frames(spark, staged), tables, source, LANGS))
        got, now = collected(spark, tables)
        assert got.entities == model.entities, k
        assert got.links == model.links, k
        assert got.payloads == model.payloads, k
        for n, old in ids.items():
            assert all(now[n][key] == i for key, i in old.items())
        ids = now


def test_a_run_without_changes_changes_nothing(spark):
    staged = frames(spark, snapshot(random.Random(9)))
    tables = fixed(spark, merge_catalogue(staged, empty(spark), 1, LANGS))
    again = merge_catalogue(staged, tables, 1, LANGS)
    for n, df in again.items():
        assert {r["_action"] for r in df.select("_action").distinct().collect()} <= {"noop", "keep"}, n
        assert sorted(map(tuple, df.drop("_action").collect())) == sorted(map(tuple, tables[n].collect())), n
    assert violations(tables) == []


def test_duplicate_links_that_are_wanted_stay(spark):
    staged = snapshot(random.Random(4))
    staged["staging_books"] = [(1, "a", "ru", "fb2", DAY, False, 1, 1)]
    staged["staging_authors"] = [(1, "a", "b", "c"), (2, "a", "b", "c")]
    staged["staging_book_authors"] = [(1, 1)]
    tables = fixed(spark, merge_catalogue(frames(spark, staged), empty(spark), 1, LANGS))
    link = tables["book_authors"].first()
    tables["book_authors"] = tables["book_authors"].union(spark.createDataFrame([(77, link["book"], link["author"])], CATALOGUE["book_authors"]))
    again = merge_catalogue(frames(spark, staged), tables, 1, LANGS)["book_authors"]
    assert sorted(r["id"] for r in again.collect()) == [link["id"], 77]


def test_last_wins(spark):
    rows = [(1, "a", 1), (1, None, 3), (1, "b", 2), (None, "x", 9), (2, None, 1)]
    df = spark.createDataFrame(rows, "k int, v string, _ord int")
    assert sorted(map(tuple, last_wins(df, ["k"]).collect()), key=repr) == [(1, None, 3), (2, None, 1)]
    assert [tuple(r) for r in last_wins(df, ["k"], required=["v"]).collect()] == [(1, "b", 2)]
    assert "WindowGroupLimit" in last_wins(df, ["k"])._jdf.queryExecution().executedPlan().toString()


def test_languages(spark):
    books = spark.createDataFrame([("ru", False), ("en", False), ("ru", True), (None, False), (None, True)], "lang string, is_deleted boolean")
    assert [r["is_deleted"] for r in flag_languages(books, ["ru"]).collect()] == [False, True, True, None, True]
    with pytest.raises(ValueError):
        flag_languages(books, [])


def test_nulls_are_not_distinct(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, None, 1, None), (1, None, 1, 2), (None, None, None, None)], "a int, b int, c int, d int")
    assert [r[0] for r in df.select(distinct_from([F.col("a"), F.col("b")], [F.col("c"), F.col("d")])).collect()] == [False, True, False]


def test_entities_merge_with_one_shuffled_join(spark):
    """The upsert and the soft delete of books share a full outer join."""
    from folioforge.operators.merge import merge_entity

    books = merge_entity(empty(spark)["books"], frames(spark, snapshot(random.Random(1)))["staging_books"], 1, ["title"], "is_deleted")
    plan = books._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("Join ") == 1
