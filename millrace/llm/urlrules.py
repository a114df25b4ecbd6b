"""URL filters: a sort-merge range join of urls with nested host and path rules.

A host becomes a canonical key: its labels in reverse order, each followed by
a dot (``www.example.net`` -> ``net.example.www.``). A rule's host then covers
the interval of all keys that start with the rule's key, and intervals of
different rules are nested or apart. Urls and rules are sorted by key; a sweep
keeps the stack of rules whose interval is open at the current url. The rules
on the stack are tried from the longest to the shortest for their path.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sampled keys for each range; like Spark's own range partitioner, they only set bounds.
SAMPLE_PER_RANGE = 20


def host_of(url: Column) -> Column:
    """Text from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Text from the end of the host to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _order(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Sweep:
    """The stack of open rules; keys must come in ascending order."""

    def __init__(self) -> None:
        #: (key, {path: verdict of the rule}, path lengths from long to short, host)
        self.open: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def _close(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def rule(self, key: str, path: str, name: str, verdict: str) -> None:
        self._close(key)
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, {}, []))
        _, paths, lengths = self.open[-1]
        # of equal rules the later verdict in the order block, allow is dropped
        paths.setdefault(path, (name, verdict))
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def judge(self, key: str, path: str) -> tuple[str, str] | None:
        """The longest rule that fits, by host and path together; of equally long ones, that with the longer host."""
        self._close(key)
        best, size = None, -1
        for own, paths, lengths in reversed(self.open):
            for n in lengths:
                if len(own) - 1 + n > size and n <= len(path) and (hit := paths.get(path[:n])):
                    best, size = hit, len(own) - 1 + n
                    break
        return best


def judge_urls(pages: DataFrame, rules: DataFrame, *, page_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict (block or allow). A rule fits its host
    and all subdomains when the url's path starts with the rule's path; the longest
    rule wins, and of two equal rules with different verdicts, block. Without a
    rule, rule is null and verdict is ``default``. Null urls and urls without
    ``://`` have empty host and path. Rules with a null part are ignored. Repeated
    rows are judged each. Other columns are ignored.

    Sorted ranges are cut at sampled (key, salt) bounds, so one very common host is
    dealt over several ranges; a rule goes to every range that its interval meets.
    """
    spark = pages.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = pages.schema[page_id].dataType.simpleString()
    probes = (
        pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("_url"))
        .select("id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"), F.xxhash64("id", "_url").alias("salt"))
        .withColumn("key", host_key(F.col("host")))
    )
    sample = probes.select("key", "salt").orderBy(F.xxhash64("salt"), "salt").limit(SAMPLE_PER_RANGE * ranges)
    drawn = sorted((_order(r.key), r.salt) for r in sample.collect())
    bounds = [drawn[len(drawn) * i // ranges] for i in range(1, ranges)] if drawn else []
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def range_of(key: pd.Series, salt: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(shared.value, (_order(k), s)) for k, s in zip(key, salt, strict=True)], dtype="int32")

    lowest, highest = -(1 << 63), (1 << 63) - 1
    usable = rules.select(F.lower("host").alias("host"), "path", "verdict").dropna().dropDuplicates()
    opened = (
        usable.withColumn("key", host_key(F.col("host")))
        .withColumn("from", range_of(F.col("key"), F.lit(lowest)))
        .withColumn("to", range_of(F.concat("key", F.lit("\U0010ffff")), F.lit(highest)))
        .select(F.explode(F.sequence("from", "to")).alias("range"), "key", F.lit(0).alias("kind"), F.lit(None).cast(id_type).alias("id"), "host", "path", "verdict")
    )
    urls = probes.select(range_of(F.col("key"), F.col("salt")).alias("range"), "key", F.lit(1).alias("kind"), "id", "host", "path", F.lit("").alias("verdict"))
    # rules come before the urls of their key; block sorts after allow, hence desc
    dealt = urls.unionByName(opened).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "range").sortWithinPartitions("range", "key", "kind", F.desc("verdict"))

    def sweep(batches):
        now, stack = None, Sweep()
        for batch in batches:
            out: list[list] = [[], [], []]
            at, keys, kinds, hosts, paths, verdicts = (batch.column(c).to_pylist() for c in ("range", "key", "kind", "host", "path", "verdict"))
            for i, kind in enumerate(kinds):
                if at[i] != now:
                    now, stack = at[i], Sweep()
                if kind:
                    hit = stack.judge(keys[i], paths[i]) or (None, default)
                    for column, value in zip(out, (i, *hit), strict=True):
                        column.append(value)
                else:
                    stack.rule(keys[i], paths[i], hosts[i] + paths[i], verdicts[i])
            rows = batch.take(pa.array(out[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("host"), rows.column("path"), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], names=[page_id, "host", "path", "rule", "verdict"])

    return dealt.mapInArrow(sweep, f"{page_id} {id_type}, host string, path string, rule string, verdict string")
