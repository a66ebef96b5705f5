import gzip
import http.server
import json
import os
import threading
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from folioforge.operators.gate import SnapshotTooSmall, passes
from folioforge.plans import update as U
from folioforge.plans.spec import CATALOGUE, ENTITIES
from folioforge.sources import fetch as G
from folioforge.sources import snapshot as N
from folioforge.sources.lease import Held, Lease, Lost

VALUES = {
    "Author": ["(1,'A','','B')", "(2,'C','','D')"],
    "Book": [f"({i},0,'2010-03-07 05:06:07','T{i}','','ru','','','fb2','',1999,'0',{','.join(['0'] * 8)},5)" for i in (1, 2, 3)],
    "BookAuthor": ["(1,1,0)", "(2,2,0)", "(3,99,0)"],
    "Translator": ["(1,2,0)"],
    "Sequence": ["(1,'S')"],
    "SequenceInfo": ["(1,1,-2)"],
    "BookAnnotation": ["(1,0,'t','x<br>y')"],
    "BookAnnotationPic": ["(1,0,'p.jpg')", "(2,0,'q.jpg')"],
    "AuthorAnnotation": ["(1,0,'t',NULL)"],
    "AuthorAnnotationPic": ["(1,0,'p.jpg')"],
    "Genre": ["(1,'c','d','m')"],
    "BookGenre": ["(9,1,1)"],
}


def dumps(folder, change=None):
    paths = {}
    for name, e in ENTITIES.items():
        rows = (change or {}).get(name, VALUES[name])
        path = folder / f"{e.file}.gz"
        path.write_bytes(gzip.compress("".join(f"INSERT INTO `t` VALUES {r};\n" for r in rows).encode()))
        paths[name] = str(path)
    return paths


@pytest.fixture
def root(spark, tmp_path):
    path = f"file://{tmp_path}/catalogue"
    N.ensure_layout(spark, path, {1: "main", 2: "other"})
    return path


def updater(spark, root, **k):
    return U.Updater(spark, root, "main", pauses=(0, 0), **k)


def test_runs_publish_versions_and_failures_change_nothing(spark, root, tmp_path):
    calls = []

    def call(hook):
        calls.append(hook.url)
        if hook.url == "bad":
            raise OSError("no")

    u = updater(spark, root, webhooks=[U.Webhook("bad"), U.Webhook("good")], call=call)
    assert u.run(dumps(tmp_path)) == 1
    assert calls == ["bad"] * 3 + ["good"] and u.state.webhook_errors_total == 1 and u.state.last_result == "ok"
    c = N.read_catalogue(spark, root)
    assert [r["title"] for r in c["books"].orderBy("remote_id").collect()] == ["T1", "T2", "T3"]
    assert c["book_authors"].count() == 2 and c["book_sequences"].first()["position"] == 2
    assert [(r["text"], r["file"]) for r in c["book_annotations"].collect()] == [("x\ny", "p.jpg")]
    assert c["author_annotations"].count() == 0 and c["sources"].count() == 2
    assert "update_rows_processed_total 17" in u.metrics_text() or u.state.rows_processed_total == sum(map(len, VALUES.values()))

    # A book goes: soft-deleted, its link deleted.
    smaller = dumps(tmp_path, {"Book": VALUES["Book"][:2], "BookAuthor": VALUES["BookAuthor"][:1]})
    assert u.run(smaller) == 2
    c = N.read_catalogue(spark, root)
    assert {r["remote_id"]: r["is_deleted"] for r in c["books"].collect()} == {1: False, 2: False, 3: True}
    assert c["book_authors"].count() == 1

    # Too small, and a broken file: nothing changes.
    with pytest.raises(SnapshotTooSmall, match="book_genres"):
        u.run(dumps(tmp_path, {"BookGenre": []}))
    (tmp_path / "broken.gz").write_bytes(b"\x1f\x8bnonsense")
    with pytest.raises(U.StageFailed, match="lib.libgenre.sql"):
        u.run(dumps(tmp_path) | {"BookGenre": str(tmp_path / "broken.gz")})
    # A title that is too long breaks a rule of the target.
    with pytest.raises(N.ConstraintViolation, match="title is longer than 256"):
        u.run(dumps(tmp_path, {"Book": [VALUES["Book"][0].replace("T1", "x" * 257), *VALUES["Book"][1:]]}))
    assert N.current_version(spark, root) == 2 and u.state.errors_total == 3

    runs = {r["id"]: r for r in N.read_runs(spark, root).collect()}
    assert [runs[i]["status"] for i in range(1, 6)] == ["success", "success", "failed", "failed", "failed"]
    assert runs[1]["rows_staged"] == sum(map(len, VALUES.values())) and "libgenre" in runs[4]["error"]
    status = json.loads(u.status())
    assert status["running"] is False and status["runs_total"] == 5 and "title" in status["last_result"]


def test_a_file_is_counted_while_it_is_written(spark, tmp_path):
    """One job reads, writes and counts a file; a second one shows reasons, where there are any."""
    context, entity = spark.sparkContext, ENTITIES["BookAuthor"]
    good = [f"INSERT INTO `t` VALUES ({i},{i + 1},0),({i},{i + 2},1);" for i in range(500)]
    bad = ["INSERT INTO `t` VALUES (1,NULL,0),(2,3,0);", "INSERT INTO `t` VALUES (1,2", "INSERT INTO `t` VALUES (7);"]
    for name, lines, want, jobs in (("good", good, (1000, 0, 0), 1), ("bad", good + bad, (1001, 2, 1), 3), ("none", ["-- nothing"], (0, 0, 0), 1)):
        path = tmp_path / f"{name}.sql"
        path.write_text("\n".join(lines) + "\n")
        context.setJobGroup(f"stage {name}", name)
        out = U.stage(spark, entity, str(path), f"{tmp_path}/staged-{name}")
        context.setLocalProperty("spark.jobGroup.id", None)
        assert out.error is None and (out.staged, out.skipped, out.unparsed) == want
        assert len(context.statusTracker().getJobIdsForGroup(f"stage {name}")) <= jobs, name
        assert out.rows.count() == want[0] and len(out.examples) == want[1] + want[2]
        assert out.rows.columns == [f.name for f in entity.fields] + ["_ord"]
    assert "unparsed line" in U.stage(spark, entity, str(tmp_path / "bad.sql"), f"{tmp_path}/again").examples
    assert "again" in U.stage(spark, entity, str(tmp_path / "bad.sql"), f"{tmp_path}/again").error


def test_files_are_fetched_and_removed(spark, root, tmp_path):
    class Files(http.server.SimpleHTTPRequestHandler):
        def __init__(self, *a, **k):
            super().__init__(*a, directory=str(tmp_path / "www"), **k)

        def log_message(self, *_):
            pass

    (tmp_path / "www" / "sql").mkdir(parents=True)
    dumps(tmp_path / "www" / "sql")
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Files)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    files = U.remote_files(f"http://127.0.0.1:{s.server_port}", str(tmp_path / "landing"))
    u = updater(spark, root)
    assert u.run(files) == 1 and list((tmp_path / "landing").iterdir()) == []
    (tmp_path / "www" / "sql" / "lib.libseq.sql.gz").unlink()
    files = U.remote_files(f"http://127.0.0.1:{s.server_port}/", str(tmp_path / "landing"), attempts=1)
    with pytest.raises(U.StageFailed, match="lib.libseq.sql"):
        u.run(files)
    assert N.current_version(spark, root) == 1 and list((tmp_path / "landing").iterdir()) == []
    s.shutdown()


def test_settings():
    from folioforge.plans.settings import Settings

    env = {"API_KEY": "k", "BASE_URL": "http://x", "WEBHOOKS": '[{"method": "get", "url": "u", "headers": {"A": "b"}}]'}
    s = Settings.load(env)
    assert (s.webhooks, s.languages, s.min_ratio, s.attempts) == ((U.Webhook("u", "GET", {"A": "b"}),), ("ru", "be", "uk"), 0.5, 3)
    assert Settings.load(env | {"MIN_STAGING_RATIO": "0.9", "ALLOWED_LANGS": "EN"}).min_ratio == 0.9
    for wrong in ({"MIN_STAGING_RATIO": "x"}, {"ALLOWED_LANGS": ","}, {"WEBHOOKS": "{"}, {"WEBHOOKS": '[{"url": "u", "method": "PUT"}]'}):
        with pytest.raises(ValueError):
            Settings.load(env | wrong)
    with pytest.raises(KeyError):
        Settings.load({})


def test_locks(spark, root, tmp_path):
    u = updater(spark, root)
    u._lock.acquire()
    with pytest.raises(U.Busy, match="this process"):
        u.run({})
    u._lock.release()
    N.write_new(spark, f"{root}/LOCK", "x")
    with pytest.raises(U.Busy, match="another process"):
        u.run({})
    N.delete(spark, f"{root}/LOCK")
    with pytest.raises(LookupError):
        U.Updater(spark, root, "unknown").run({})
    assert N.read_text(spark, f"{root}/LOCK") is None and N.current_version(spark, root) == 0


def test_a_lock_ends_with_its_owner(spark, root, tmp_path):
    """A process died: its lock and its running line are left."""
    now = datetime.now(timezone.utc)
    N.write_new(spark, f"{root}/LOCK", "dead")
    N.append_run(spark, root, (1, 1, "running", now - timedelta(days=2), None, 3, 4, None))
    with pytest.raises(U.Busy, match="another process"):
        updater(spark, root).run(dumps(tmp_path))
    os.utime(root.removeprefix("file://") + "/LOCK", (0, time.time() - 700))
    u = updater(spark, root)
    assert u.run(dumps(tmp_path)) == 1
    runs = {r["id"]: (r["status"], r["error"]) for r in N.read_runs(spark, root).collect()}
    assert runs == {1: ("failed", U.ABANDONED), 2: ("success", None)}
    assert N.read_text(spark, f"{root}/LOCK") is None
    assert f"update_last_success_timestamp_seconds {int(datetime.fromisoformat(u.state.last_success).timestamp())}\n" in u.metrics_text()
    assert "update_last_success_timestamp_seconds 0\n" in updater(spark, root).metrics_text()


def test_a_lock_is_renewed_and_its_loss_stops_publication(spark, root, tmp_path):
    path = f"{root}/LOCK"
    with Lease(spark, path, 0.5) as mine:
        time.sleep(1.2)
        with pytest.raises(Held):
            Lease(spark, path, 0.5).__enter__()
        mine.check()
        N.write_new(spark, path, "other", overwrite=True)
        with pytest.raises(Lost):
            mine.check()
        with pytest.raises(Lost):
            N.publish(spark, root, {}, mine.check)
    assert N.read_text(spark, path) == "other" and N.current_version(spark, root) == 0
    # Only a lock that is there means that someone is at work: other faults of the store are not hidden.
    with pytest.raises(Exception) as e:
        U.Updater(spark, "nosuchstore://x", "main").run({})
    assert not isinstance(e.value, U.Busy)


def test_statuses_of_runs_are_checked(spark, root):
    with pytest.raises(N.ConstraintViolation, match="no status"):
        N.append_run(spark, root, (1, 1, "done", None, None, 0, 0, None))


def test_old_runs_are_repaired(spark, root, tmp_path):
    now = datetime(2024, 5, 5, 12, tzinfo=timezone.utc)
    N.append_run(spark, root, (1, 1, "running", now - timedelta(days=2), None, 3, 4, None))
    N.append_run(spark, root, (2, 1, "running", now - timedelta(hours=2), None, 0, 0, None))
    updater(spark, root, now=lambda: now).run(dumps(tmp_path))
    runs = {r["id"]: r for r in N.read_runs(spark, root).collect()}
    assert (runs[1]["status"], runs[1]["error"], runs[1]["rows_staged"]) == ("failed", U.ABANDONED, 3)
    assert runs[2]["status"] == "running" and runs[3]["status"] == "success"


def test_layout_is_made_once(spark, root):
    N.ensure_layout(spark, root, {5: "x"})
    assert N.read_catalogue(spark, root)["sources"].count() == 2
    with pytest.raises(FileNotFoundError):
        N.read_catalogue(spark, root + "-none")


def test_violations(spark):
    t = {n: spark.createDataFrame([], s) for n, s in CATALOGUE.items()}
    t["sequences"] = spark.createDataFrame([(1, 1, 1, "a"), (2, 1, 1, "b"), (3, 1, 3, None), (4, 1, 4, "x" * 256 + "  ")], CATALOGUE["sequences"])
    t["book_genres"] = spark.createDataFrame([(1, 1, 1)], CATALOGUE["book_genres"])
    assert N.violations(t) == ["sequences: name is null (1)", "sequences: source, remote_id is not unique", "book_genres: book refers to no row of books", "book_genres: genre refers to no row of genres"]


def test_ratio(spark):
    df = spark.createDataFrame([(0, 0), (5, 10), (4, 10), (0, 1), (10, 0)], "s long, t long")
    assert [r[0] for r in df.select(passes(F.col("s"), F.col("t"))).collect()] == [True, True, False, False, True]


def test_totals():
    ok, bad = U.Staged("A", None, 3, 1), U.Staged("B", error="b: x")
    assert U.totals([ok, U.Staged("C", None, 4, 0)]) == (7, 1)
    with pytest.raises(U.StageFailed, match="b: x; c: y") as e:
        U.totals([ok, bad, U.Staged("C", error="c: y")])
    assert (e.value.staged, e.value.skipped) == (3, 1)


def test_languages_and_keys():
    assert U.parse_languages(None) == ("ru", "be", "uk") and U.parse_languages(" RU ,, en") == ("ru", "en")
    with pytest.raises(ValueError):
        U.parse_languages(" , ")
    assert U.authorized("k", "k") and U.authorized(b"k", "k")
    assert not any(U.authorized(h, "k") for h in (None, "", "K", b"\xff\xfe"))


class Server(http.server.BaseHTTPRequestHandler):
    body, lie, failures = b"x" * 100_000, 0, 0
    hits = 0

    def do_GET(self):  # noqa: N802
        Server.hits += 1
        if Server.hits <= Server.failures:
            self.send_error(500)
            return
        self.send_response(200)
        self.send_header("Content-Length", str(len(self.body) + Server.lie))
        self.end_headers()
        self.wfile.write(self.body)

    def log_message(self, *_):
        pass


@pytest.fixture
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    Server.hits = Server.lie = Server.failures = 0
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_fetch(server, tmp_path):
    pauses = []
    Server.failures = 2
    path = G.fetch(G.dump_url(server, "lib.x.sql"), str(tmp_path / "a.gz"), pause=pauses.append)
    assert open(path, "rb").read() == Server.body and pauses == [0.5, 1.0]
    assert [p.name for p in tmp_path.iterdir()] == ["a.gz"]


def test_short_answers_fail(server, tmp_path):
    Server.lie = 10
    with pytest.raises(G.FetchError):
        G.fetch(server, str(tmp_path / "a.gz"), pause=lambda s: None)
    assert Server.hits == 3 and list(tmp_path.iterdir()) == []


def test_stalls_fail(tmp_path):
    import socket

    with socket.socket() as s:
        s.bind(("127.0.0.1", 0))
        s.listen(5)
        with pytest.raises(G.FetchError):
            G.fetch(f"http://127.0.0.1:{s.getsockname()[1]}/", str(tmp_path / "a"), attempts=1, idle_seconds=0.2)
