"""Tables in the shared folder that a job writes for itself, and their end.

A table is deleted by ``discard`` as soon as nothing will read it, by ``run`` when the block that made it ends, by ``release``,
and at the latest when the Python process ends. A result that a query returns unread may rest on such tables, so whoever asked
for it opens the block: ``with scratch.run(spark): query(spark, path).write.parquet(out)`` leaves the folder as it was.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: Makes Spark delete a query's shuffle files when it has ended, not when its plan is collected as garbage.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_OPEN: dict[str, int] = {}  # folders that are still there, in the order they were named, and the thread that did
_LOCK = threading.RLock()
_WRITERS: dict[str, tuple[int, str]] = {}  # by application: writers that want CLEAN now, and its value before them


def root(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Where none is set, a local one if all tasks run in this process, else an error."""
    own = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not own and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return (own or f"file://{tempfile.gettempdir()}/tidegrid-checkpoints").rstrip("/")


def folder(spark: SparkSession, what: str) -> str:
    """A name below root that nobody else uses; what is written there ends with the run."""
    path = f"{root(spark)}/{what}-{uuid.uuid4().hex}"
    with _LOCK:
        _OPEN[path] = threading.get_ident()
    return path


@contextmanager
def _cleaning(spark: SparkSession) -> Iterator[None]:
    """CLEAN is on while any thread writes, and as it was when the last one has ended."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        n, before = _WRITERS.get(app, (0, spark.conf.get(CLEAN, "false")))
        _WRITERS[app] = n + 1, before
        spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        with _LOCK:
            n, before = _WRITERS[app]
            if n > 1:
                _WRITERS[app] = n - 1, before
            else:
                del _WRITERS[app]
                spark.conf.set(CLEAN, before)


def saved(df: DataFrame, what: str, reader: SparkSession | None = None, **options: int) -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage ends here, and any executor can be lost. The shuffle
    files of the query that writes it go at once, so a chain of tables holds no more of them than its largest link. It is read by
    another session, if one is given, and written with these options."""
    path = folder(df.sparkSession, what)
    with _cleaning(df.sparkSession):
        df.write.options(**options).parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


def _delete(path: str) -> None:
    gateway = SparkContext._gateway
    if gateway is not None:
        place = gateway.jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(SparkContext._active_spark_context._jsc.hadoopConfiguration() if SparkContext._active_spark_context else gateway.jvm.org.apache.hadoop.conf.Configuration()).delete(place, True)
    with _LOCK:
        _OPEN.pop(path, None)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def discard(df: DataFrame) -> None:
    """Deletes the folder of a saved table that nothing will read again."""
    found = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    names = {f.rsplit("/", 1)[1] for f in found}
    for path in [p for p in list(_OPEN) if p.rsplit("/", 1)[1] in names] or found:
        _delete(path)


def release(paths: list[str] | None = None) -> None:
    """Deletes these folders, or all that are still there."""
    for path in list(_OPEN) if paths is None else paths:
        _delete(path)


@contextmanager
def run(spark: SparkSession) -> Iterator[None]:
    """What this thread writes to the shared folder within the block is gone after it."""
    before = set(_OPEN)
    try:
        yield
    finally:
        release([p for p, who in list(_OPEN.items()) if p not in before and who == threading.get_ident()])


def alone(spark: SparkSession, what: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The saved table of what make() gives. Tables that make() wrote on its way are gone."""
    before = set(_OPEN)
    path = folder(spark, what)
    made = make()
    with _cleaning(spark):
        made.write.parquet(path)
    release([p for p, who in list(_OPEN.items()) if p not in before and p != path and who == threading.get_ident()])
    return spark.read.schema(made.schema).parquet(path)


@atexit.register
def _at_exit() -> None:
    with suppress(Exception):  # the session's process may be gone already
        release()
