"""Limits of time, and scheduler pools of what runs side by side."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from folioforge.plans import update as U
from folioforge.session import TimedOut, time_limit, together
from folioforge.sources import snapshot as N
from folioforge.sources.lease import Lease
from test_update import dumps, root, updater  # noqa: F401


def slow(spark):
    return spark.range(4).select(F.udf(lambda i: time.sleep(15) or i, "long")("id").alias("x"))


def test_jobs_of_other_threads_are_cancelled_too(spark):
    began = time.monotonic()
    with pytest.raises(TimedOut, match="the step took more than 1 seconds"), time_limit(spark, 1, "the step"):
        together({"one": lambda: slow(spark).count(), "two": lambda: slow(spark).agg(F.sum("x")).collect()})
    assert time.monotonic() - began < 12
    # Jobs outside the block, and later ones, are left alone.
    with time_limit(spark, 60, "the step"):
        assert spark.range(10).count() == 10
    with time_limit(spark, None, "the step"):
        assert together({"a": lambda: spark.range(3).count()}) == {"a": 3}
    with pytest.raises(ZeroDivisionError), time_limit(spark, 60, "the step"):
        1 / 0


def test_a_merge_that_takes_too_long_fails_and_changes_nothing(spark, root, tmp_path, monkeypatch):  # noqa: F811
    real = U.merge_catalogue

    def merge(staged, *rest):
        slow(spark).count()
        return real(staged, *rest)

    monkeypatch.setattr(U, "merge_catalogue", merge)
    u = updater(spark, root, merge_seconds=1)
    with pytest.raises(TimedOut, match="the merge"):
        u.run(dumps(tmp_path))
    assert N.current_version(spark, root) == 0 and N.read_text(spark, f"{root}/LOCK") is None
    assert [r["status"] for r in N.read_runs(spark, root).collect()] == ["failed"] and u.state.errors_total == 1
    monkeypatch.undo()
    assert u.run.__self__ is u and updater(spark, root).run(dumps(tmp_path)) == 1


def test_a_run_waits_for_the_lock_as_long_as_it_may(spark, root, tmp_path):  # noqa: F811
    other = Lease(spark, f"{root}/LOCK").__enter__()
    with pytest.raises(U.Busy):
        updater(spark, root, lock_seconds=0.5).run(dumps(tmp_path))
    threading.Timer(1.5, lambda: other.__exit__(None, None, None)).start()
    assert updater(spark, root, lock_seconds=60).run(dumps(tmp_path)) == 1


def test_each_job_has_a_pool_of_its_name(spark):
    context = spark.sparkContext
    context.setLocalProperty("spark.job.description", "outer")
    found = together({name: lambda: (context.getLocalProperty("spark.scheduler.pool"), context.getLocalProperty("spark.job.description")) for name in ("books", "authors")})
    context.setLocalProperty("spark.job.description", None)
    assert found == {"books": ("books", "outer"), "authors": ("authors", "outer")}
    # Properties of one job are not another's, also while both are under way.
    meet = threading.Barrier(3)

    def own():
        meet.wait()
        return context.getLocalProperty("spark.scheduler.pool")

    assert together(dict.fromkeys("abc", own)) == {"a": "a", "b": "b", "c": "c"}
