"""The registered query of each operator, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, jaccard, media, pii, sharding, suffixes, toxicity, urlrules, warc
from millrace.llm.shared import new_folder

#: The rules that op2 judges by: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary() -> str:
    """The vocabulary file that op8 and the pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def op2_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op3_ngram_jaccard(spark, sf_dir):
    return jaccard.similarity_components(_table(spark, sf_dir, "documents"))


def op4_sharding(spark, sf_dir):
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARDS)


def op5_media_columns(spark, sf_dir):
    return media.describe(media.store(_table(spark, sf_dir, "documents")))


def op6_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op7_warc(spark, sf_dir):
    """Writes the archives to the shared folder, then reads their records back."""
    pages = _table(spark, sf_dir, "pages")
    folder = new_folder(spark, "warc")
    warc.write_archives(pages, folder)
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(spark, folder).select(
        F.col("id").cast(kind).alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").cast(kind).alias("refers_to"),
    )


def op8_bpe(spark, sf_dir):
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary())


def op9_pii(spark, sf_dir):
    return pii.find_spans(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_url_filters": op2_url_filters,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_sharding": op4_sharding,
    "op5_media_columns": op5_media_columns,
    "op6_toxicity": op6_toxicity,
    "op7_warc": op7_warc,
    "op8_bpe": op8_bpe,
    "op9_pii": op9_pii,
    "op10_decontamination": op10_decontamination,
}

_UPPER_TO_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_SHINGLES = r"""
    {name}_words AS (
        SELECT {key} AS id, regexp_extract_all(translate(text, {case}), '[^\x20\x09-\x0D]+') AS w FROM {table}),
    {name}_sets AS (
        SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
        FROM {name}_words)"""


def shingle_ctes(name: str, table: str, key: str) -> str:
    return _SHINGLES.format(name=name, table=table, key=key, case=_UPPER_TO_LOWER)


ORACLES = {
    "op2_url_filters": f"""
        WITH u AS (
            SELECT page_id,
                translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), {_UPPER_TO_LOWER}) AS host,
                coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        rules(h, p, v) AS (VALUES {", ".join(map(str, URL_RULES))}),
        hits AS (
            SELECT u.page_id, u.host, u.path, h || p AS rule, v,
                row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS k
            FROM u LEFT JOIN rules ON (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p))
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM hits WHERE k = 1""",
    "op3_ngram_jaccard": f"""
        WITH RECURSIVE {shingle_ctes("d", "documents", "doc_id")},
        sizes AS (SELECT id, count(*) AS n FROM d_sets GROUP BY id),
        shared AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM d_sets x JOIN d_sets y ON x.s = y.s AND x.id <> y.id GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
        reach(node, goal) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.goal)
        SELECT node AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(goal) AS component_id
        FROM reach LEFT JOIN sizes ON id = node GROUP BY node""",
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        h AS (SELECT *, upper(sha1(body)) AS s, min(page_id) OVER (PARTITION BY body) AS first FROM p),
        g AS (SELECT *, [CAST('0x' || substr(s, 1 + 5 * i, 5) AS INT) FOR i IN range(8)] AS n FROM h)
        SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
            array_to_string(list_transform(range(32), lambda k:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (n[1 + k // 4] >> (15 - 5 * (k % 4))::INT) % 32, 1)), '') AS payload_digest,
            CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
        FROM g""",
    "op10_decontamination": f"""
        WITH {shingle_ctes("d", "documents", "doc_id")}, {shingle_ctes("b", "benchmark", "item_id")},
        sizes AS (SELECT id, count(*) AS n FROM b_sets GROUP BY id),
        shared AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS c FROM d_sets d JOIN b_sets b USING (s) GROUP BY ALL)
        SELECT doc_id, item_id, n AS n_shingles, c AS n_common
        FROM shared JOIN sizes ON id = item_id WHERE 100 * c >= 75 * n""",
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
