"""Reference concepts derived from the driver's tables, once as DataFrames and once as SQL.

Both forms of a fixture have the same columns and rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import table

RAW_FILES = """raw_files AS (
    SELECT doc_id AS asset_id, source AS unit, lang, n_chars AS size, sha256(text) AS checksum,
        source || '/' || lang || '/' || doc_id || '.txt' AS raw_key,
        CASE doc_id % 5 WHEN 0 THEN 'failed' WHEN 1 THEN NULL WHEN 2 THEN 'pending' ELSE 'completed' END AS status
    FROM documents)"""


def raw_files(spark, sf_dir: str) -> DataFrame:
    status = F.expr("CASE doc_id % 5 WHEN 0 THEN 'failed' WHEN 1 THEN NULL WHEN 2 THEN 'pending' ELSE 'completed' END")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("asset_id"),
        F.col("source").alias("unit"),
        "lang",
        F.col("n_chars").alias("size"),
        F.sha2("text", 256).alias("checksum"),
        F.concat("source", F.lit("/"), "lang", F.lit("/"), "doc_id", F.lit(".txt")).alias("raw_key"),
        status.alias("status"),
    )


LABEL_ROWS = """label_rows AS (
    SELECT doc_id AS label_id, doc_id // 2 AS asset_id,
        CASE WHEN quality = 1 THEN 'finalized' WHEN toxic = 1 THEN 'reviewed' ELSE 'auto_generated' END AS review_status,
        CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS category
    FROM labels)"""


def label_rows(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("label_id"),
        F.expr("doc_id div 2").alias("asset_id"),
        F.expr("CASE WHEN quality = 1 THEN 'finalized' WHEN toxic = 1 THEN 'reviewed' ELSE 'auto_generated' END").alias("review_status"),
        F.expr("CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END").alias("category"),
    )


JOBS = """jobs AS (
    SELECT l_orderkey AS batch, l_linenumber AS seq, l_extendedprice AS cost, l_shipmode_ AS engine,
        CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_linestatus = 'F' THEN 'done' WHEN l_returnflag = 'A' THEN 'done' ELSE 'open' END AS status
    FROM (SELECT *, 'e' || (l_suppkey % 4) AS l_shipmode_ FROM lineitem))"""


def jobs(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("batch"),
        F.col("l_linenumber").alias("seq"),
        F.col("l_extendedprice").alias("cost"),
        F.concat(F.lit("e"), F.col("l_suppkey") % 4).alias("engine"),
        F.expr("CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_linestatus = 'F' THEN 'done' WHEN l_returnflag = 'A' THEN 'done' ELSE 'open' END").alias("status"),
    )


EVENT_SPANS = """spans AS (
    SELECT event_id, user_id AS asset_id, event_type AS category,
        epoch_us(ts) / 1e6 - 1704067200.0 AS start_sec, epoch_us(ts) / 1e6 - 1704067200.0 + value * 600 AS end_sec, value
    FROM events)"""


def event_spans(spark, sf_dir: str) -> DataFrame:
    """Events as media-time intervals of an asset; seconds since the table's first day."""
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - 1704067200.0
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("asset_id"), F.col("event_type").alias("category"), start.alias("start_sec"), (start + F.col("value") * 600).alias("end_sec"), "value"
    )


FRAMES = """frames AS (SELECT vec_id, embedding::DOUBLE[] AS vec, label AS gt, vec_id % 7 AS grp FROM embeddings WHERE vec_id % 4 <> 0),
bank AS (SELECT vec_id AS gidx, embedding::DOUBLE[] AS vec, label AS cls, CASE WHEN vec_id % 8 = 0 THEN 'A' ELSE 'B' END AS version FROM embeddings WHERE vec_id % 4 = 0)"""


def frames(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").where("vec_id % 4 <> 0").select("vec_id", F.col("embedding").alias("vec"), F.col("label").alias("gt"), (F.col("vec_id") % 7).alias("grp"))


def bank(spark, sf_dir: str) -> DataFrame:
    version = F.when(F.col("vec_id") % 8 == 0, "A").otherwise("B")
    return table(spark, sf_dir, "embeddings").where("vec_id % 4 = 0").select(F.col("vec_id").alias("gidx"), F.col("embedding").alias("vec"), F.col("label").alias("cls"), version.alias("version"))
