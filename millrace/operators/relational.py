"""Catalog operators: predicates over nullable columns, ranking, merging and queues.

Each is a composition of joins, windows and expressions that Catalyst plans; none
collects rows. Names follow what the operator does to a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# --- predicates ---------------------------------------------------------------


def under_folder(key: Column, folder: str) -> Column:
    """Key lies under a folder; an empty folder matches everything. The folder is taken literally."""
    return key.startswith(folder.rstrip("/") + "/") if folder else F.lit(True)


def with_default(status: Column, default: str) -> Column:
    """A status in which null means ``default``."""
    return F.coalesce(status, F.lit(default))


def null_or_in(value: Column, allowed: Sequence) -> Column:
    return value.isNull() | value.isin(*allowed)


def null_or_not_in(value: Column, banned: Sequence) -> Column:
    return value.isNull() | ~value.isin(*banned)


def older_than(moment: Column, as_of: Column, minutes: int) -> Column:
    """Moment lies more than ``minutes`` (1 at least) before ``as_of``."""
    return moment < as_of - F.make_interval(mins=F.lit(max(1, minutes)))


def basename(key: Column) -> Column:
    return F.regexp_extract(key, r"[^/]+$", 0)


def stem(key: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(basename(key), r"\.[^.]*$", "")


def contains_ignoring_case(text: Column, needle: str) -> Column:
    return F.contains(F.lower(text), F.lit(needle.lower()))


def any_of(text: Column, exact: Sequence[str], patterns: Sequence[str]) -> Column:
    """Equal to one of ``exact`` or like one of ``patterns``; with neither, nothing matches."""
    tests = ([text.isin(*exact)] if exact else []) + [text.like(p) for p in patterns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def implies(condition: Column, consequence: Column) -> Column:
    return ~condition | consequence


# --- backlogs and existence ---------------------------------------------------


def backlog(base: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``base`` without a counterpart in ``done``."""
    return base.join(done.select(*on).distinct(), list(on), "left_anti")


def having(base: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return base.join(other.select(*on), list(on), "left_semi")


def missing_any(base: DataFrame, parts: dict[str, DataFrame], on: Sequence[str]) -> DataFrame:
    """Rows that lack a counterpart in at least one part, with a flag for each part."""
    for name, part in parts.items():
        flagged = part.select(*on).distinct().withColumn(f"has_{name}", F.lit(True))
        base = base.join(flagged, list(on), "left").withColumn(f"has_{name}", F.coalesce(f"has_{name}", F.lit(False)))
    return base.where(reduce(lambda a, b: a | b, [~F.col(f"has_{n}") for n in parts]))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose non-null key has no parent."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


# --- ranking ------------------------------------------------------------------


def first_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key; the order must be total for a defined result."""
    return frame.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def cap_per_group(frame: DataFrame, keys: Sequence[str], order: Sequence[Column], per_group: int, limit: int, overall: Sequence[Column]) -> DataFrame:
    """At most ``per_group`` rows of each key, then the first ``limit`` of all."""
    return first_per_key(frame, keys, order, per_group).orderBy(*overall).limit(max(1, limit))


def prioritised(frame: DataFrame, urgent: Column, limit: int, order: Sequence[Column]) -> DataFrame:
    """All urgent rows, then others in order until ``limit`` rows are reached.

    Urgent rows are never cut. Only the first ``limit`` others are ranked.
    """
    first = frame.where(urgent)
    rest = frame.where(~F.coalesce(urgent, F.lit(False))).orderBy(*order).limit(limit)
    ranked = rest.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))
    taken = first.agg(F.count("*").alias("_taken"))
    fill = ranked.crossJoin(F.broadcast(taken)).where(F.col("_rank") <= limit - F.col("_taken")).drop("_rank", "_taken")
    return first.unionByName(fill)


def first_match(base: DataFrame, key: str, tiers: Sequence[DataFrame], value: str) -> DataFrame:
    """For each key the value of the first tier that has one."""
    ranked = reduce(DataFrame.unionByName, [t.select(key, value).withColumn("tier", F.lit(i)) for i, t in enumerate(tiers)])
    best = ranked.where(F.col(value).isNotNull()).groupBy(key).agg(F.min_by(F.struct("tier", value), F.struct("tier", value)).alias("hit"))
    return base.join(best, key, "left").select(base.columns + [F.col("hit.tier").alias("tier"), F.col(f"hit.{value}").alias(value)])


def round_robin(frame: DataFrame, stratum: str, order: Sequence[Column], n: int) -> DataFrame:
    """One row of each stratum a round, until n rows; ranks beyond n can't be reached."""
    ranked = frame.withColumn("round", F.row_number().over(Window.partitionBy(stratum).orderBy(*order)))
    return ranked.where(F.col("round") <= n).orderBy("round", stratum).limit(n)


def hash_sample(frame: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """n rows in the order of a seeded hash of their key; the same rows on every run."""
    return frame.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), key).limit(n)


def natural_key(text: Column, width: int = 10) -> Column:
    """A sort key in which runs of digits compare as numbers."""
    parts = F.regexp_extract_all(text, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, width, "0")).otherwise(p)), "")


# --- merging ------------------------------------------------------------------


def upsert(base: DataFrame, new: DataFrame, keys: Sequence[str], guard: Column | None = None) -> DataFrame:
    """Rows of both by key; a new row replaces an old one unless the old row meets ``guard``.

    ``new`` must hold a key once. Old rows without a new one stay in place: only an
    equi-join on the keys is needed, and the guard reads old columns.
    """
    kept = F.coalesce(guard, F.lit(False)) if guard is not None else F.lit(False)
    old = base.withColumn("_old", F.lit(True)).withColumn("_kept", kept).alias("o")
    incoming = new.withColumn("_new", F.lit(True)).alias("n")
    joined = old.join(incoming, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full_outer")
    take_old = F.col("o._old").isNotNull() & (F.col("n._new").isNull() | F.col("o._kept"))
    return joined.select(*(F.when(take_old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in base.columns))


def insert_or_ignore(base: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Base rows, and the first new row of each key that base lacks."""
    fresh = first_per_key(new.join(base.select(*keys), list(keys), "left_anti"), keys, order)
    return base.unionByName(fresh.select(base.columns))


def replace_scope(base: DataFrame, new: DataFrame, scope: Sequence[str], replaceable: Column, guard: Column | None = None) -> DataFrame:
    """Delete replaceable base rows of the scopes in ``new``, then add ``new``.

    A scope that has a base row meeting ``guard`` is left alone altogether.
    """
    if guard is not None:
        held = base.where(guard).select(*scope).distinct()
        new = new.join(held, list(scope), "left_anti")
    touched = new.select(*scope).distinct()
    kept = base.where(~F.coalesce(replaceable, F.lit(False))).unionByName(base.where(replaceable).join(touched, list(scope), "left_anti"))
    return kept.unionByName(new.select(base.columns))


def without_twins(frame: DataFrame, keys: Sequence[str], final: Column) -> DataFrame:
    """Drop rows that aren't final where a final row of the same keys exists."""
    twins = frame.where(final).select(*keys).distinct()
    return frame.where(final).unionByName(frame.where(~F.coalesce(final, F.lit(False))).join(twins, list(keys), "left_anti"))


def job_status(done: Column, failed: Column, total: Column) -> Column:
    """State of a batch of jobs from its counters."""
    return (
        F.when(total == 0, "pending")
        .when(done + failed < total, F.when(done + failed > 0, "running").otherwise("pending"))
        .when(failed == 0, "succeeded")
        .when(done == 0, "failed")
        .otherwise("partial_success")
    )


def duplicate_keepers(frame: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows of keys that occur more than once, with ``keeper`` true on the first of each."""
    window = Window.partitionBy(*keys)
    marked = frame.withColumn("_n", F.count("*").over(window)).withColumn("keeper", F.row_number().over(window.orderBy(*order)) == 1)
    return marked.where("_n > 1").drop("_n")
