"""Personal data: pattern spans, and terms that disclose the entities they stand with.

Everything here is DataFrame expressions. Base spans come from four patterns. The
information-theoretic part (in the manner of C-sanitisation) then looks at the terms
of documents that hold an entity, an entity being a kind and a value of base spans.
Over the whole corpus it counts the distinct texts with the term, with the entity, and
with both, wherever in the text they stand, and takes

    disclosure = PMI(term; entity) / IC(entity)

where the texts with the term count ``SMOOTHING`` more, all without the entity:
a term's few sightings are weak evidence, the weaker the smaller the corpus. A term
that occurs only with the entity has nearly 1. Terms of ``min_disclosure`` or more
are spans of the kind ``term`` wherever they occur in a text that holds the entity.
Sanitising removes base spans and words for a placeholder of their kind, and
generalises terms that hold digits to "a number" or "a code".

Texts are told by their MD5, and repeated rows count once. A text's spans are rows
until the end, so that a text of many spans takes time in proportion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import result, written

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
MIN_TERM_CHARS = 3
_WORD = r"[\p{L}\p{N}]{%d,}+" % MIN_TERM_CHARS
MIN_DISCLOSURE = 0.75
#: Texts without the entity that each term is credited with.
SMOOTHING = 1.5
PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", TERM: "[TERM]"}
#: What terms with digits are generalised to.
GENERAL = {"number": "[NUMBER]", "code": "[CODE]"}

# Each pattern finds the leftmost non-overlapping matches of the plain pattern in linear
# time: runs are taken possessively, and a match starts at the start of a run or where
# the match before it ended. Card and phone also demand their number of digits, up to the
# end of the plain pattern's match; no shorter match can start inside a failing one.
_PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9](?:[ ().-]*+[0-9]){8,14}+(?![ ().-]*+[0-9])",
}
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string,at:int>>"


def luhn(number: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""
    digits = F.reverse(F.regexp_replace(number, "[^0-9]", ""))
    each = F.transform(F.split(digits, ""), lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise(c.try_cast("int") * 2 - F.when(c.try_cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid() -> Column:
    parts = F.transform(F.split("value", r"\."), lambda p: F.ltrim(p, F.lit("0")))
    ip = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return F.when(F.col("kind") == "ip", ip).when(F.col("kind") == "card", luhn(F.col("value"))).otherwise(True)


def _body(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _may_hold(text: Column) -> Column:
    """Whether a text has a character that every base span needs."""
    return text.rlike("[0-9@]")


def _matches(kind: str, rank: int, pattern: str) -> Column:
    """The kind with all its matches in ``_text`` and the lengths of the gaps before them."""
    found = F.regexp_extract_all(F.col("_text"), F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split("_text", pattern, -1), F.length)
    return F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), found.alias("found"), gaps.alias("gaps"))


def _placed(matches: DataFrame) -> DataFrame:
    """(_hash, start, rank, end, kind, value) of ``matches`` (_hash, m); running sums of lengths give the places."""
    pieces = matches.select("_hash", "m.kind", "m.rank", F.posexplode(F.arrays_zip(F.col("m.gaps").alias("gap"), F.col("m.found").alias("value"))).alias("k", "p"))
    pieces = pieces.where(F.col("p.value").isNotNull()).select("_hash", "kind", "rank", "k", "p.value", F.length("p.value").alias("n"), (F.col("p.gap") + F.length("p.value")).alias("step"))
    end = F.sum("step").over(Window.partitionBy("_hash", "kind").orderBy("k"))
    return pieces.select("_hash", (end - F.col("n")).cast("int").alias("start"), "rank", end.cast("int").alias("end"), "kind", "value")


def _words() -> Column:
    """The different terms of ``_text``: runs of letters and digits, in lower case."""
    found = F.regexp_extract_all(F.col("_text"), F.lit(_WORD), F.lit(0))
    return F.array_distinct(F.transform(F.array_distinct(found), F.lower))


def _distinct_texts(docs: DataFrame, text: str, only: Column | None = None) -> DataFrame:
    read = docs.select(_body(text).alias("_text"))
    read = read if only is None else read.where(only)
    return read.groupBy(F.md5("_text").alias("_hash")).agg(F.first("_text").alias("_text"))


def _disclosed(texts: DataFrame, base: DataFrame, terms: DataFrame, min_disclosure: float) -> DataFrame:
    """(_hash, term) of the terms that disclose an entity of the text, wherever they stand in it."""
    of_text = base.select("_hash", F.concat_ws(":", "kind", F.lower("value")).alias("entity")).distinct()
    entities = of_text.groupBy("entity").agg(F.count("*").alias("with_entity"))
    mentioned = of_text.groupBy("_hash").agg(F.collect_list("entity").alias("_entities"))
    contexts = texts.select("_hash", "_words").join(mentioned, "_hash").select("_hash", "_entities", F.explode("_words").alias("term")).select("_hash", "term", F.explode("_entities").alias("entity"))
    pairs = contexts.groupBy("entity", "term").agg(F.count("*").alias("both"))
    # the empty term stands once in each text
    total = F.broadcast(terms.where("term = ''").agg(F.max("with_term").alias("texts")))
    pmi = F.log(F.col("both") * F.col("texts") / ((F.col("with_term") + SMOOTHING) * F.col("with_entity")))
    content = F.log(F.col("texts") / F.col("with_entity"))
    known = pairs.join(entities, "entity").join(terms, "term").crossJoin(total)
    disclosing = known.where((content > 0) & (pmi / content >= min_disclosure)).select("entity", "term")
    return contexts.join(disclosing, ["entity", "term"]).select("_hash", "term").distinct()


def spans_of_texts(docs: DataFrame, *, text: str = "text", min_disclosure: float = MIN_DISCLOSURE) -> DataFrame:
    """(_hash, _spans): all spans of each distinct text that holds a base span, by start, then kind.

    A span is (start, rank, end, kind, value, at): ``at`` is where the text that no
    earlier span covers begins. Added spans that overlap a base span are left out.
    """

    def make() -> DataFrame:
        hinted = _distinct_texts(docs, text, _may_hold(F.col("_text")))
        base_matches = [_matches(kind, rank, _PATTERN[kind]) for rank, kind in enumerate(KINDS)]
        found = hinted.select("_hash", "_text", F.filter(F.array(*base_matches), lambda m: F.size(m["found"]) > 0).alias("_found"))
        texts = written(found.where(F.size("_found") > 0).withColumn("_words", _words()), "texts")
        base = written(_placed(texts.select("_hash", F.explode("_found").alias("m"))).where(_valid()), "spans")
        words = _distinct_texts(docs, text).select(F.explode(F.concat(F.array(F.lit("")), _words())).alias("term"))
        terms = written(words.groupBy("term").agg(F.count("*").alias("with_term")), "terms")
        wanted = written(_disclosed(texts, base, terms, min_disclosure), "wanted")
        dirty = texts.join(wanted.select("_hash").distinct(), "_hash", "left_semi")
        places = _placed(dirty.select("_hash", _matches(TERM, len(KINDS), _WORD).alias("m"))).withColumn("term", F.lower("value"))
        every = base.unionAll(places.join(wanted, ["_hash", "term"]).select(base.columns))
        of_text = Window.partitionBy("_hash")
        before = of_text.orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
        after = of_text.orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, -1)
        own = F.col("kind") != TERM
        edges = every.withColumns({"_before": F.max(F.when(own, F.col("end"))).over(before), "_after": F.min(F.when(own, F.col("start"))).over(after)})
        apart = edges.where(own | ((F.coalesce("_before", "start") <= F.col("start")) & (F.coalesce("_after", "end") >= F.col("end"))))
        placed = apart.withColumn("at", F.coalesce(F.max("end").over(before), F.lit(0)))
        return placed.groupBy("_hash").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind", "value", "at"))).cast(_SPAN).alias("_spans"))

    return result(docs.sparkSession, "pii", make)


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of each row.

    spans joins kind:start:end (code points, end exclusive) of base and added spans
    in order of start; base_sha256 hashes the base ones alone. Null and empty texts
    have none. Repeated rows have a row each and change no span; other columns are
    ignored. Null ids are ids like others.
    """
    found = spans_of_texts(docs, text=text, **limits)
    base = F.filter("_spans", lambda s: s["kind"] != TERM)
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    told = found.select("_hash", *map(count, KINDS), F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("_spans")).alias("spans"))
    rows = docs.select(F.col(doc_id).alias("_doc"), F.md5(_body(text)).alias("_hash")).join(told, "_hash", "left")
    zero = [F.coalesce(f"n_{kind}", F.lit(0).cast("long")).alias(f"n_{kind}") for kind in KINDS]
    return rows.select(F.col("_doc").alias(doc_id), *zero, F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def _rewritten(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind's placeholder; spans that overlap count as the first one."""
    label = F.create_map(*(F.lit(x) for pair in PLACEHOLDER.items() for x in pair))

    def piece(s: Column) -> Column:
        general = F.when(s["value"].rlike(r"^\p{N}+$"), GENERAL["number"]).when(s["value"].rlike(r"\p{N}"), GENERAL["code"])
        put = F.when(s["kind"] == TERM, F.coalesce(general, F.lit(PLACEHOLDER[TERM]))).otherwise(F.element_at(label, s["kind"]))
        return F.concat(F.substring(text, s["at"] + 1, s["start"] - s["at"]), put)

    fresh = F.transform(F.filter(spans, lambda s: s["start"] >= s["at"]), piece)
    last = F.array_max(F.transform(spans, lambda s: s["end"]))
    return F.concat(F.array_join(fresh, ""), F.substring(text, last + 1, F.length(text)))


def sanitised(docs: DataFrame, *, text: str = "text", **limits) -> DataFrame:
    """The rows with all their columns; base and added spans of the text are replaced by placeholders.

    Rows without a digit or an at sign can't hold base spans; they pass unchanged and
    unshuffled, null texts among them.
    """
    names = docs.columns
    hash_, spans = _unused(names, "hash"), _unused(names, "spans")
    found = spans_of_texts(docs, text=text, **limits).select(F.col("_hash").alias(hash_), F.col("_spans").alias(spans))
    hinted = F.coalesce(_may_hold(F.col(text).cast("string")), F.lit(False))
    rows = docs.where(hinted).withColumn(hash_, F.md5(_body(text))).join(found, hash_, "left")
    kind = docs.schema[text].dataType
    changed = F.when(F.col(spans).isNotNull(), _rewritten(_body(text), F.col(spans)).cast(kind)).otherwise(F.col(text))
    return docs.where(~hinted).unionAll(rows.select(*(changed.alias(n) if n == text else F.col(n) for n in names)))


def _unused(names: list[str], name: str) -> str:
    taken = {n.lower() for n in names}
    name = f"_{name}"
    while name in taken:
        name = f"_{name}"
    return name
