"""Session helpers: where derived tables are kept between steps of a job."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths handed out by this driver and not yet removed, by session.
_HELD: dict[SparkSession, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session that names none keeps derived tables beside its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/derived"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten.

    It is removed when the driver ends, or with the ``job`` it was made in.
    """
    path = f"{shared_root(spark)}/notequarry/{name}-{uuid.uuid4().hex}"
    _HELD.setdefault(spark, []).append(path)
    return path


def mounted_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of a path on a file system that is mounted where tasks run, else None."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(target).toUri().getPath() if system.getUri().getScheme() == "file" else None


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders of derived tables through Spark's own file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    _HELD[spark] = [p for p in _HELD.get(spark, []) if p not in set(paths)]


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what was derived inside; results must be written by then."""
    before = set(_HELD.get(spark, []))
    try:
        yield
    finally:
        remove(spark, [p for p in _HELD.get(spark, []) if p not in before])


@atexit.register
def _clean() -> None:
    for spark, paths in list(_HELD.items()):
        if spark.sparkContext._jsc is not None:
            remove(spark, list(paths))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    Cuts the lineage and survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
