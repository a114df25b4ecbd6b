"""File sources and sinks beyond plain tables: folders, ledgers, exports and sealed data sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, extensions: Sequence[str] = ()) -> DataFrame:
    """(path, length, modified) of all files below a folder; contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    if extensions:
        found = found.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*(e.lower().lstrip(".") for e in extensions)))
    return found


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of all files below a folder, each read once."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def read_ledger(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """JSON lines in which the last record of a key counts; the order is file name, then line."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    parsed = lines.withColumn("r", F.from_json("value", schema)).where(F.col(f"r.{key}").isNotNull())
    last = parsed.groupBy(F.col(f"r.{key}").alias("_key")).agg(F.max_by("r", F.struct("_file", "_block", "_line")).alias("r"))
    return last.select("r.*")


def read_bank(spark: SparkSession, path: str, text: str = "prompt") -> DataFrame:
    """CSV rows with gidx, their place among all rows of the file; rows without text are dropped after counting."""
    rows = spark.read.option("header", True).option("multiLine", True).csv(path)
    placed = rows.withColumn("gidx", F.monotonically_increasing_id())  # a multi-line file is one partition
    return placed.where(F.length(F.trim(F.coalesce(F.col(text), F.lit("")))) > 0)


def outdated(source: DataFrame, copy: DataFrame, key: str, size: str) -> DataFrame:
    """Source files that the copy lacks or has in another size."""
    other = copy.select(key, F.col(size).alias("_size"))
    return source.join(other, key, "left").where(F.col("_size").isNull() | (F.col("_size") != F.col(size))).drop("_size")


def replace_table(frame: DataFrame, path: str) -> tuple[int, int]:
    """Overwrite a Parquet table; returns its rows before and after."""
    spark = frame.sparkSession
    before = spark.read.parquet(path).count() if _exists(spark, path) else 0
    frame.write.mode("overwrite").parquet(path)
    return before, spark.read.parquet(path).count()


def seal(parts: dict[str, DataFrame], path: str) -> None:
    """Write a data set's parts, and its SEALED marker only when all of them are complete."""
    for name, frame in parts.items():
        frame.write.mode("error").parquet(f"{path}/{name}")
    spark = next(iter(parts.values())).sparkSession
    spark.createDataFrame([(n,) for n in sorted(parts)], "part string").coalesce(1).write.mode("error").json(f"{path}/SEALED")


def read_sealed(spark: SparkSession, path: str, part: str) -> DataFrame:
    """A part of a sealed data set; an unsealed one is refused."""
    if not _exists(spark, f"{path}/SEALED/_SUCCESS"):
        raise FileNotFoundError(f"{path} is not sealed")
    return spark.read.parquet(f"{path}/{part}")


def export_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
