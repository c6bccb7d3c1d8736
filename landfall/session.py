"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_settled: ContextVar[list[str] | None] = ContextVar("settled", default=None)


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("landfall")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        # Small inputs still use all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "4k")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local master may go without it; it then gets a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="landfall-")
    return _local_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/landfall/{app}/{label}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    This cuts the lineage in a way that outlives lost executors, and gives the
    optimizer the true size: a join with the result is broadcast when it is
    below spark.sql.autoBroadcastJoinThreshold and shuffled otherwise.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    paths = _settled.get()
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables settled inside the block when it ends.

    Jobs run in such a block; a DataFrame built on a settled table must not be
    used after it.
    """
    paths: list[str] = []
    token = _settled.set(paths)
    try:
        yield
    finally:
        _settled.reset(token)
        for path in paths:
            remove(spark, path)


def _location(spark: SparkSession, path: str):
    """The file system of a path and the path in it, local or not."""
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _location(spark, path)
    return system.exists(location)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all below it; nothing if it does not exist."""
    system, location = _location(spark, path)
    system.delete(location, True)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern of the file system, in one call."""
    system, location = _location(spark, pattern)
    hadoop = spark.sparkContext._jvm.org.apache.spark.deploy.SparkHadoopUtil
    # As one text, for a call for each path would take longer than the listing.
    shown = hadoop.get().globPath(system, location).mkString("\n")
    return sorted(shown.split("\n")) if shown else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target must not exist, its parents are made."""
    system, location = _location(spark, source)
    _, place = _location(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(location, place):
        raise OSError(f"could not move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    system, location = _location(spark, path)
    stream = system.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file whole, in place of an older one."""
    part = f"{path.rsplit('/', 1)[0]}/_part-{uuid.uuid4().hex}"
    system, location = _location(spark, part)
    stream = system.create(location, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    remove(spark, path)
    move(spark, part, path)
