"""Scalar column functions: text, hashing, geometry, statistics and binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- text ------------------------------------------------------------------------


def norm_text(text: Column) -> Column:
    """Lower case, trimmed, white space collapsed."""
    return F.regexp_replace(F.trim(F.lower(text)), r"\s+", " ")


def content_hash(text: Column) -> Column:
    """First 16 hexadecimal digits of the SHA-256 of the normalised text."""
    return F.substring(F.sha2(norm_text(text), 256), 1, 16)


def norm_str(value: Column, default: str = "") -> Column:
    """Trimmed text; null and blank give the default."""
    text = F.trim(value.cast("string"))
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, text).otherwise(F.lit(default))


def version_tag(version: Column) -> Column:
    """``v1.0.8.4`` -> ``v1084``."""
    return F.regexp_replace(version, r"\.", "")


def thousandths(value: Column) -> Column:
    """A number of 0 or more, or NaN, with three decimals, as C's ``%.3f`` writes it; up to 2^50.

    Java rounds the shortest decimal form half up, C the binary value itself, half to even.
    Values near the middle of two thousandths are therefore rounded in integers.
    """
    whole = F.floor(value)
    scaled = (value - whole) * 2.0**52
    product = scaled.cast("long") * 1000
    below = F.shiftright(product, 52)
    over = (product.bitwiseAND(F.lit(2**52 - 1)) - F.lit(2**51)) + (scaled - scaled.cast("long")) * 1000
    part = below + ((over > 0) | ((over == 0) & (below % 2 == 1))).cast("long")
    exact = F.concat((whole + (part == 1000).cast("long")).cast("string"), F.lit("."), F.lpad((part % 1000).cast("string"), 3, "0"))
    middle = F.abs(value * 1000 - F.floor(value * 1000) - 0.5) < 0.01
    plain = F.when(F.isnan(value), "nan").when(value == float("inf"), "inf")
    return F.coalesce(plain, F.when(middle & (value < 2.0**50), exact).otherwise(F.format_string("%.3f", value)))


def lookup(value: Column, names: dict[str, str], fallback: Column) -> Column:
    """A name from a small fixed table, or the fallback."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), fallback)


def parse_tags(text: Column) -> Column:
    """Tags of a JSON array or of a comma-separated list; trimmed, without blanks."""
    parsed = F.from_json(text, "array<string>")
    listed = F.when(text.startswith("["), parsed).otherwise(F.split(text, ","))
    return F.filter(F.transform(F.coalesce(listed, F.array().cast("array<string>")), lambda t: F.trim(t)), lambda t: t != "")


def without_fences(text: Column) -> Column:
    """Text of a model's answer without Markdown code fences."""
    return F.regexp_replace(F.regexp_replace(text, r"(?m)^\s*```[A-Za-z]*\s*$", ""), r"^\s+|\s+$", "")


def numbered_items(text: Column) -> Column:
    """Map from number to text of ``1. text`` lines; a repeated number keeps its first text."""
    numbers = F.regexp_extract_all(text, F.lit(r"(?m)^\s*(\d+)[.)]\s+(.+)$"), F.lit(1))
    bodies = F.regexp_extract_all(text, F.lit(r"(?m)^\s*(\d+)[.)]\s+(.+)$"), F.lit(2))
    pairs = F.zip_with(numbers, bodies, lambda n, b: F.struct(n.cast("int").alias("k"), F.trim(b).alias("v")))
    seen = F.aggregate(pairs, F.array().cast("array<struct<k:int,v:string>>"), lambda acc, p: F.when(F.exists(acc, lambda x: x["k"] == p["k"]), acc).otherwise(F.concat(acc, F.array(p))))
    return F.map_from_entries(seen)


def trigrams(text: Column) -> Column:
    """Distinct trigrams of lower-case words, each padded with two spaces before and one after."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    each = F.transform(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))))
    return F.array_distinct(F.flatten(each))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared over all distinct trigrams; two texts without any have 0."""
    x, y = trigrams(a), trigrams(b)
    shared = F.size(F.array_intersect(x, y))
    every = F.size(x) + F.size(y) - shared
    return F.when(every > 0, shared / every).otherwise(0.0)


# --- hashes ------------------------------------------------------------------------


def hamming64(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit values as 16 hexadecimal digits; halves avoid the sign bit."""
    half = lambda h, at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")
    return F.bit_count(half(a, 1).bitwiseXOR(half(b, 1))) + F.bit_count(half(a, 9).bitwiseXOR(half(b, 9)))


# --- geometry ------------------------------------------------------------------------


def interval_iou(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    shared = F.greatest(F.least(e1, e2) - F.greatest(s1, s2), F.lit(0.0))
    union = (e1 - s1) + (e2 - s2) - shared
    return F.when(union > 0, shared / union).otherwise(0.0)


def box_iou(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """IoU of boxes (x1, y1, x2, y2); 0 without overlap or area."""
    width = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    height = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    shared = width * height
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - shared
    return F.when(union > 0, shared / union).otherwise(0.0)


def yolo_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Centre and size as shares of the image, clamped to 0..1; null for an invalid box or image."""
    share = lambda v, of: F.least(F.greatest(v / of, F.lit(0.0)), F.lit(1.0))
    box = F.struct(share(x + w / 2, width).alias("cx"), share(y + h / 2, height).alias("cy"), share(w, width).alias("w"), share(h, height).alias("h"))
    return F.when((w > 0) & (h > 0) & (width > 0) & (height > 0), box)


def histogram_iou(a: Column, b: Column) -> Column:
    """Sum of bin minima over sum of bin maxima."""
    total = lambda f: F.aggregate(F.zip_with(a, b, f), F.lit(0.0), lambda t, v: t + v)
    top = total(lambda x, y: F.greatest(x, y).cast("double"))
    return F.when(top > 0, total(lambda x, y: F.least(x, y).cast("double")) / top).otherwise(0.0)


# --- statistics ------------------------------------------------------------------------

Z95 = 1.959964


def wilson(hits: Column, total: Column, z: float = Z95) -> tuple[Column, Column]:
    """Bounds of the Wilson score interval; (0, 0) without trials."""
    p, n = hits / total, total.cast("double")
    middle = p + z * z / (2 * n)
    spread = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    bound = lambda v: F.when(total > 0, v / (1 + z * z / n)).otherwise(0.0)
    return bound(middle - spread), bound(middle + spread)


def mcnemar(b: Column, c: Column) -> Column:
    """Two-sided exact binomial p of b against c discordant cases, capped at 1; 1 without any."""
    n, k = (b + c).cast("int"), F.least(b, c).cast("int")
    places = F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>"))
    # the largest term as a logarithm, and the others as parts of it, from it downwards
    largest = F.aggregate(places, F.lit(0.0), lambda acc, i: acc + F.log((n - k + i).cast("double")) - F.log(i.cast("double"))) - n * F.log(F.lit(2.0))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc, i):
        at = k - i + 1
        term = acc["term"] * at / (n - at + 1)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    p = F.exp(largest + F.log(F.aggregate(places, start, step, lambda acc: acc["sum"])))
    return F.when(n > 0, F.least(2 * p, F.lit(1.0))).otherwise(1.0)


def sample_tier(n: Column) -> Column:
    return F.when(n == 0, "no_gt").when(n < 30, "counts_only").when(n < 100, "exploratory").otherwise("reportable")


def floor_bin(value: Column, width: float) -> Column:
    return F.floor(value / width) * width


def f1(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1 with zero for empty denominators."""
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return p, r, ratio(2 * p * r, p + r)
