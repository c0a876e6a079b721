"""Session helpers: a tuned local builder and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor, wait
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_scope: ContextVar[str] = ContextVar("work_scope", default="")


def build_session(app: str = "tallyhouse", cpus: int | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    n = cpus or os.cpu_count() or 8
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Partition folders that a task writes side by side before it sorts its rows by folder.
OPEN_WRITERS = 16
#: The same where each task holds all months or feed files; thousands of folders are slower with so many open.
SPREAD_WRITERS = 128


def tune(spark: SparkSession) -> None:
    """Settings of the session that the warehouse counts on; none of them changes a result."""
    cores = spark.sparkContext.defaultParallelism
    settings = {
        "spark.sql.session.timeZone": "UTC",
        # Listing a table of many store-day folders takes a few tasks a core, not one a folder.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": 4 * cores,
        # A task that writes few folders keeps them all open: its rows are not sorted, so they do not spill.
        "spark.sql.maxConcurrentOutputFileWriters": OPEN_WRITERS,
        # Written tables are read a few times and count against the disk; splits bound what a task aggregates.
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.files.maxPartitionBytes": "64m",
        "spark.sql.files.openCostInBytes": "1m",
        # A side whose partitions are all small as shuffled is hashed; the large side streams by unsorted.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        # What a query shuffled goes from the disk when it ends, not when the driver's memory happens to be collected.
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    for key, value in settings.items():
        spark.conf.set(key, str(value))


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tallyhouse-")


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables: the cluster's checkpoint folder.

    Only a local session without the setting gets a folder of its own. A folder that the cluster
    names is taken as it is; that all hosts see it is the cluster's promise.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return _local_root()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder, in this application's part of it, that no earlier call has used."""
    return f"{_own_root(spark, _scope.get())}/{label}-{uuid.uuid4().hex[:12]}"


def _own_root(spark: SparkSession, scope: str = "") -> str:
    root = f"{work_root(spark)}/tallyhouse/{spark.sparkContext.applicationId}"
    return f"{root}/{scope}" if scope else root


@contextmanager
def work_scope(scope: str) -> Iterator[None]:
    """Folders made inside lie in a part of the work folder that can be cleared by its name."""
    token = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(token)


@contextmanager
def passing_work(spark: SparkSession) -> Iterator[None]:
    """Folders made inside are deleted at the end: frames that read them must not be used after."""
    scope = "/".join(filter(None, (_scope.get(), f"passing-{uuid.uuid4().hex[:12]}")))
    try:
        with work_scope(scope):
            yield
    finally:
        clear_work(spark, scope)


@contextmanager
def spread_writers(spark: SparkSession, spread: bool) -> Iterator[None]:
    """Writes inside keep the folders of a spread table open side by side."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    held = spark.conf.get(key)
    if spread:
        spark.conf.set(key, str(SPREAD_WRITERS))
    try:
        yield
    finally:
        spark.conf.set(key, held)


def together(*steps: Callable[[], object]) -> list:
    """Run independent steps side by side and return their results; all end before the first error is raised.

    Jobs of one step fill the cores that the tail, the planning or the listing of another leaves idle.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(copy_context().run, step) for step in steps]
        wait(running)
    return [done.result() for done in running]


def clear_work(spark: SparkSession, scope: str = "") -> None:
    """Delete what this application has written below the shared folder, or in one scope; its frames are dead then."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_root(spark, scope))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
