"""Session helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial
from typing import TypeVar

from pyspark import SparkContext, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

#: Spark's setting for shuffle files that go when their query ends; without it they stay until the driver's garbage is collected, which may be never.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SHIPPED: set[str] = set()
_OWN_SCRATCH: dict[str, str] = {}
_FREEING, _FREEING_LOCK = [], threading.Lock()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the cluster's ``spark.checkpoint.dir``. Only a local master, as in
    tests, may leave that unset: then a temporary folder of this machine is
    used, and removed when the process ends. Tables in the cluster's folder
    outlive the application that wrote them, for results are read from them;
    the folder is the cluster's to clear.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir is not set, and executors of {master} don't share this machine's folders")
        app = spark.sparkContext.applicationId
        if app not in _OWN_SCRATCH:
            folder = tempfile.mkdtemp(prefix="spark-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            _OWN_SCRATCH[app] = "file://" + folder
        shared = _OWN_SCRATCH[app]
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    Later plans start from the files, so a lost executor costs a re-read and
    not the work that led up to them, and values that depend on the plan (row
    numbers of a partition, say) are fixed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def free_shuffles(spark: SparkSession | None) -> Iterator[None]:
    """Within the block, and blocks of other threads that began in it, each query's shuffle files go when it ends; the session's setting comes back with the last of them."""
    with _FREEING_LOCK:
        if spark and not _FREEING:
            _FREEING.append((spark, spark.conf.get(FREE_SHUFFLES, "false")))
            spark.conf.set(FREE_SHUFFLES, "true")
        elif _FREEING:
            _FREEING.append(None)
        held = bool(_FREEING)
    try:
        yield
    finally:
        with _FREEING_LOCK:
            if held and len(_FREEING) == 1:
                session, before = _FREEING.pop()
                session.conf.set(FREE_SHUFFLES, before)
            elif held:
                _FREEING.pop()


def together(jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Results of jobs that don't depend on each other, each with Spark jobs of its own at the same time.

    Each job's Spark jobs are in a scheduler pool of its name, so that under fair
    scheduling a large one does not hold up the others. What else was set for the
    calling thread, its tags among others, holds for all of them. Jobs keep what
    they find in files (``materialize``), so their shuffles go as they end.
    """

    def pooled(name: str, job: Callable[[], T]) -> T:
        if context := SparkContext._active_spark_context:
            context.setLocalProperty("spark.scheduler.pool", name)
        return job()

    session = SparkSession.getActiveSession()

    def inherit(job: Callable[[], T]) -> Callable[[], T]:
        # Anew for each job: what is copied once would be one set of properties for all, the last pool among them.
        return inheritable_thread_target(session)(job) if session else inheritable_thread_target(job)

    with free_shuffles(session), ThreadPoolExecutor(max(1, len(jobs))) as pool:
        running = {name: pool.submit(inherit(partial(pooled, name, job))) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


class TimedOut(RuntimeError):
    """A step took longer than it may."""


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None, what: str) -> Iterator[None]:
    """Cancel all Spark jobs that the block has started, in other threads too, once it takes too long; then raises ``TimedOut``. A block that ends all the same has ended well."""
    if seconds is None:
        yield
        return
    context, tag, over = spark.sparkContext, f"folioforge-{uuid.uuid4().hex}", threading.Event()
    done = threading.Event()

    def watch() -> None:
        if not done.wait(seconds):
            over.set()
            # Again and again: between two jobs there is nothing to cancel.
            while not done.wait(0.2):
                context.cancelJobsWithTag(tag)

    context.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield
    except Exception as error:
        if over.is_set():
            raise TimedOut(f"{what} took more than {seconds:g} seconds") from error
        raise
    finally:
        done.set()
        context.removeJobTag(tag)


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, wherever they start.

    The sources (a few dozen kB) go out through Spark's own file distribution,
    once per application.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(__file__))
        fd, path = tempfile.mkstemp(prefix="folioforge-", suffix=".zip")
        with os.fdopen(fd, "wb") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, dirs, names in os.walk(root):
                dirs[:] = [d for d in dirs if d != "__pycache__"]
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("folioforge", os.path.relpath(full, root)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark
