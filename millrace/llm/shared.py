"""The folder that the driver and all executors share, for tables written between steps.

Tables are removed as soon as nothing reads them any more: ``scope`` removes at its
end what was written inside it, and a table that an operator returns belongs to the
scope around the operator. What belongs to no scope is removed when Spark ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders of each open scope, the innermost last.
_open: list[list[str]] = []


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return f"file://{tempfile.gettempdir()}/shared"
    raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path, not yet in use, under ``spark.checkpoint.dir``; the scope that is open removes it.

    Only a session in one process may do without that setting.
    """
    path = f"{_base(spark)}/{purpose}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    else:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove the folders made inside, at the end or on an error."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove(spark, path)


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame's rows, written as Parquet to the shared folder and read again.

    This cuts the lineage: a lost executor costs no more than the steps since.
    """
    path = new_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def result(spark: SparkSession, purpose: str, make) -> DataFrame:
    """What ``make()`` returns, as a table of the scope around; all that was written for it is removed."""
    with scope(spark):
        frame = make()
        inner = _open.pop()
        try:
            kept = written(frame, purpose)
        finally:
            _open.append(inner)
    return kept


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``new_folder`` through Spark's own file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
