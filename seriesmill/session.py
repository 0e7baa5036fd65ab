"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC; every time in the library is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Refuse a session in another zone, in which months and days would be other ones."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"the session's time zone is {zone}; use session.prepare(spark)")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run on rows are found there by module name; an installed
    package or ``--py-files`` does the same.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        name = os.path.join(tempfile.mkdtemp(prefix="package-"), "seriesmill")
        sc.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(here), os.path.basename(here)))
        _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is missing a local session gets its own temporary
    folder; a cluster session is refused, because a folder on one machine
    would be lost with that machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="seriesmill-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


_owned: list[list[str]] = []


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; the innermost :func:`scratch` owns it."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _owned:
        _owned[-1].append(path)
    return path


@contextmanager
def noted(paths: list[str]):
    """Notes in ``paths`` the intermediate tables that are made inside, for an owner that outlives the block."""
    _owned.append(paths)
    try:
        yield
    finally:
        _owned.pop()


@contextmanager
def scratch(spark: SparkSession):
    """Removes, at its end, the intermediate tables that are made inside.

    For a step whose result is stored, or read to its end, before the block ends:

        with scratch(spark):
            operator(rows).write.parquet(path)
    """
    paths: list[str] = []
    try:
        with noted(paths):
            yield
    finally:
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written once as Parquet below the shared folder and read from there, and its path."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder, and read from there.

    Cuts the lineage: what follows does not depend on how often, or in which
    order, the tasks before it ran.
    """
    return written_at(df, label)[0]
