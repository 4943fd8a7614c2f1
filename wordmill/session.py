"""Session settings the jobs are tuned for. All of them can be overridden by spark-submit."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Documents can be long: small Arrow batches keep a Python worker's buffer in the megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def build_session(app_name: str = "wordmill", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; ``settings`` (dots written as ``__``) win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}
    for key, value in chosen.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (like ``--py-files``)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="wordmill-package-"), "wordmill.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def _setting(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)


_local_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a session inside one JVM (``local[n]``, as in tests) gets a folder of its
    own; a cluster has to name one.
    """
    named = _setting(spark, "spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="wordmill-shared-"))
    return f"file://{_local_folder[0]}"


_staged: list[str] = []


class Staging:
    """What was staged inside a ``staging`` block."""

    def __init__(self):
        self.paths: list[str] = []
        self.kept: list[str] = []

    def keep_last(self) -> str:
        """Let the frame staged last outlive the block; the folder can be given to ``release`` later."""
        self.kept.append(self.paths.pop())
        return self.kept[-1]


_scope: ContextVar[Staging | None] = ContextVar("staging", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Staging]:
    """Remove what is staged inside the block when it ends, also by an error.

    For jobs that end with their result written: frames that read what was staged can't be used afterwards.
    """
    outer, scope = _scope.get(), Staging()
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)
        if outer is not None:  # what is kept here is the outer block's
            outer.paths += scope.kept
        release(spark, *scope.paths)


def release(spark: SparkSession, *paths: str) -> None:
    """Remove staged folders."""
    for path in paths:
        if path in _staged:
            _staged.remove(path)
            remove_path(spark, path)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it from there.

    The rows are fixed from then on: a lost executor costs a read, not the work above. Readers
    prune columns and see the sizes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    scope = _scope.get()
    for paths in [_staged] if scope is None else [_staged, scope.paths]:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system of its path."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_staged(spark: SparkSession) -> None:
    """Remove what ``stage`` has written; for callers that are done with its frames."""
    while _staged:
        remove_path(spark, _staged.pop())


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage, so that losing an executor cannot change its rows."""
    return stage(df)


def spread(scan: DataFrame) -> DataFrame:
    """Spread the rows of a small scan over all cores; a scan with enough splits stays as it is.

    Cleaning is bound by CPU, and a file of a single row group would be a single task. On a corpus
    with at least as many splits as cores this does nothing and moves nothing.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


MAX_BROADCAST_BYTES = 64 << 20


def is_bounded(df: DataFrame, most: int, most_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``most`` rows and its strings at most ``most_bytes`` in sum.

    Measured up to one row beyond the bound; hand in a frame that is cheap to read.
    """
    strings = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    size = F.sum(sum(strings, F.lit(0))).alias("size")
    found = df.limit(most + 1).agg(F.count(F.lit(1)).alias("n"), size).first()
    return found.n <= most and (found["size"] or 0) <= most_bytes


def broadcast_if_bounded(df: DataFrame, most: int, most_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it is small in rows and bytes; otherwise Spark joins it by its own estimate.

    The table is staged first, so that measuring and joining compute it once.
    """
    table = stage(df)
    return F.broadcast(table) if is_bounded(table, most, most_bytes) else table
