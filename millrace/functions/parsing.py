"""Reading of model answers, names and payloads, as column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_json(text: Column) -> Column:
    """A model's answer without code fences and text around the object, with straight quotes and without trailing commas."""
    body = F.regexp_replace(text, r"```[A-Za-z]*", "")
    body = F.regexp_extract(F.translate(body, "“”‘’", "\"\"''"), r"(?s)\{.*\}", 0)
    return F.regexp_replace(F.regexp_replace(body, r"[\r\n]+", " "), r",\s*([}\]])", "$1")


def relevance(text: Column) -> Column:
    """relevance_score of an answer within 0 to 1; null if it is missing, true or false, or no number."""
    found = F.get_json_object(clean_json(text), "$.relevance_score").try_cast("double")
    return F.when(found.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), found)))


def classification(text: Column, allowed: list[str]) -> Column:
    """predicted_class of an answer in lower case, if it is one of ``allowed``; else null."""
    found = F.lower(F.trim(F.get_json_object(clean_json(text), "$.predicted_class")))
    return F.when(found.isin(*[a.strip().lower() for a in allowed]), found)


def path_component(name: Column) -> Column:
    """Lower-case slug of a name: spaces as underscores, other characters than letters, digits, ``._-`` dropped; never empty.

    Accents are dropped from Latin letters by a table of the common ones.
    """
    plain = F.translate(name, "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY")
    kept = F.regexp_replace(F.regexp_replace(F.translate(plain, " ", "_"), r"[^A-Za-z0-9._-]", ""), "_+", "_")
    slug = F.lower(F.regexp_replace(kept, r"^[_.]+|[_.]+$", ""))
    return F.when(F.coalesce(slug, F.lit("")) == "", "unnamed").otherwise(slug)


def uuid5(space: uuid.UUID, name: Column) -> Column:
    """The name-based UUID (version 5) of a name in a name space."""
    digest = F.sha1(F.concat(F.unhex(F.lit(space.hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    parts = [F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12)]
    return F.concat_ws("-", *parts)


def display_width(text: Column) -> Column:
    """Cells of a text in a terminal; Hangul, kana and Han characters take two."""
    wide = F.regexp_replace(text, r"[^ᄀ-ᅟ⺀-꓏가-힣豈-﫿＀-｠]", "")
    return F.length(text) + F.length(wide)


def expiry(issued: Column, seconds: Column, now: Column) -> Column:
    """Seconds until a signed link expires; 0 once it has."""
    return F.greatest(F.lit(0).cast("long"), F.unix_seconds(issued) + seconds - F.unix_seconds(now))


def box_of_corners(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """left, top, width, height of any two opposite corners, to two places; null without an area."""
    box = F.struct(
        F.round(F.least(x1, x2), 2).alias("x"), F.round(F.least(y1, y2), 2).alias("y"), F.round(F.abs(x2 - x1), 2).alias("w"), F.round(F.abs(y2 - y1), 2).alias("h")
    )
    return F.when((F.abs(x2 - x1) > 0) & (F.abs(y2 - y1) > 0), box)
