"""Filter and order specifications, as data, turned into columns.

A specification has ``conjunction`` (and, or) and ``items``; an item has filter (a
column), operator, value and perhaps a child item, which is combined with and.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cast(value, column: Column, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def _empty(column: Column, kind: T.DataType) -> Column:
    """Null, and blank text, zero counters and empty lists."""
    if isinstance(kind, T.StringType):
        return column.isNull() | (column == "")
    if isinstance(kind, T.NumericType):
        return column.isNull() | (column == 0)
    if isinstance(kind, T.ArrayType):
        return column.isNull() | (F.size(column) == 0)
    return column.isNull()


def ids_of(text: str) -> list[str]:
    """Ids of a list separated by commas, semicolons or spaces."""
    return [part for part in re.split(r"[,; ]+", text) if part]


def predicate(frame: DataFrame, item: dict) -> Column | None:
    """The condition of one item with its child; None when its value is null. A bad pattern matches nothing."""
    kind, column = frame.schema[item["filter"]].dataType, F.col(item["filter"])
    operator, value = item["operator"], item["value"]
    if value is None:
        return None
    cast = lambda v: F.lit(v).cast(kind)
    text = F.lower(column.cast("string"))
    if operator in ("in", "not_in"):
        inside = column.between(cast(value["min"]), cast(value["max"]))
        found = inside if operator == "in" else ~inside
    elif operator in ("in_list", "not_in_list"):
        values = ids_of(value) if isinstance(value, str) else value
        inside = column.isin(*(cast(v) for v in values)) if values else F.lit(False)
        found = inside if operator == "in_list" else ~inside
    elif operator == "empty":
        found = _empty(column, kind) if value else ~_empty(column, kind)
    elif operator in ("contains", "not_contains"):
        inside = F.contains(text, F.lit(str(value).lower()))
        found = inside if operator == "contains" else ~F.coalesce(inside, F.lit(False))
    elif operator == "regex":
        try:
            re.compile(value)
            found = column.cast("string").rlike(value)
        except re.error:
            found = F.lit(False)
    else:
        compare = {
            "equal": lambda c, v: c == v,
            "not_equal": lambda c, v: c != v,
            "less": lambda c, v: c < v,
            "less_or_equal": lambda c, v: c <= v,
            "greater": lambda c, v: c > v,
            "greater_or_equal": lambda c, v: c >= v,
        }
        found = compare[operator](column, cast(value))
    child = predicate(frame, item["child"]) if item.get("child") else None
    return found if child is None else found & child


def apply_filters(frame: DataFrame, spec: dict) -> DataFrame:
    tests = [p for p in (predicate(frame, item) for item in spec.get("items", [])) if p is not None]
    if not tests:
        return frame
    either = spec.get("conjunction", "and") == "or"
    return frame.where(reduce((lambda a, b: a | b) if either else (lambda a, b: a & b), tests))


def apply_order(frame: DataFrame, key: str, tie: str) -> DataFrame:
    """Sort by one column (a leading minus: descending), nulls last, then by a unique tie column."""
    column = key.lstrip("-")
    return frame.orderBy(F.desc_nulls_last(column) if key.startswith("-") else F.asc_nulls_last(column), tie)


def select_items(frame: DataFrame, key: str, chosen: DataFrame, everything: bool) -> DataFrame:
    """Chosen rows, or with ``everything`` all but the chosen ones."""
    return frame.join(chosen.select(key), key, "left_anti" if everything else "left_semi")
