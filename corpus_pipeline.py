"""A training-data pipeline over ``documents``; its stages follow in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's ``docs``. Stages work on
all that their predecessor kept; all but the last return the columns of their docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, jaccard, pii, toxicity
from millrace.llm.registry import vocabulary
from millrace.llm.shared import new_folder, remove, scope


def without_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by compression distance, learnt from the labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group that the shingle similarity join links."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.decontaminated(docs, items)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by placeholders; n_chars follows the text."""
    n_chars = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars")
    return pii.sanitised(docs).withColumn("n_chars", n_chars)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the remaining documents."""
    return bpe.round_trip(docs, vocabulary())


STAGES = [
    ("toxicity", without_toxicity),
    ("jaccard", without_near_copies),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("bpe", as_tokens),
]

#: Training, token merging and the disclosure of terms have no SQL; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, after every stage in order; what earlier stages wrote is removed."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        out = new_folder(spark, name)
        with scope(spark):
            stage(spark, docs, sf_dir).write.parquet(out)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
