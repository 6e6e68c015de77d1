"""Ranked search and filters over entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions.text import fold

# Rank of each reason for a match.
RANKS = {"canonical_exact": 0, "alias_exact": 1, "external_id_exact": 2, "reference_label_exact": 3, "prefix": 4, "external_prefix": 5, "substring": 6, "external_substring": 7}


def match_rank(needle: str, canonical: Column, alias: Column, external: Column, labels: Column) -> Column:
    """Best rank of a needle among arrays of canonical names, aliases, external ids and
    reference labels; null if it matches nowhere."""
    needle = needle.strip().lower()
    names, outside = F.concat(canonical, alias), F.concat(external, labels)

    def any_of(values: Column, test) -> Column:
        return F.exists(values, lambda v: test(fold(v)))

    def equal(v: Column) -> Column:
        return v == needle

    def begins(v: Column) -> Column:
        return v.startswith(needle)

    def holds(v: Column) -> Column:
        return v.contains(needle)

    tests = [(canonical, equal), (alias, equal), (external, equal), (labels, equal), (names, begins), (outside, begins), (names, holds), (outside, holds)]
    out = None
    for rank, (values, test) in enumerate(tests):
        out = F.when(any_of(values, test), rank) if out is None else out.when(any_of(values, test), rank)
    return out


def ranked(entities: DataFrame, needle: str, limit: int = 20) -> DataFrame:
    """Entities (entity_id, name) that match, best first, ties by name and id."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be 1 to 200")
    none = F.array().cast("array<string>")
    rank = match_rank(needle, F.array("name"), none, none, none)
    return entities.withColumn("rank", rank).where("rank is not null").orderBy("rank", fold(F.col("name")), "entity_id").limit(limit)


def filtered(contexts: DataFrame, entity_type: str | None = None, has_identity: bool | None = None, provider: str | None = None, reference_status: str | None = None) -> DataFrame:
    """Contexts that pass every filter given; provider and status are tested on any
    reference each. ``contexts`` has entity_type, identity_id and refs, an array of
    structs (provider, reference_status)."""
    out = contexts
    if entity_type is not None:
        out = out.where(F.col("entity_type") == entity_type)
    if has_identity is not None:
        out = out.where(F.col("identity_id").isNotNull() == has_identity)
    if provider is not None:
        out = out.where(F.exists("refs", lambda r: r["provider"] == provider))
    if reference_status is not None:
        out = out.where(F.exists("refs", lambda r: r["reference_status"] == reference_status))
    return out


def predicate_relevance(predicates: DataFrame, source_text: str, limit: int) -> DataFrame:
    """Predicates (predicate_id, label) by words shared with a text, five more if the
    whole label stands in it."""
    text = F.lit(source_text.lower())
    words = F.array_distinct(F.split(F.lower("label"), r"[^a-z0-9]+"))
    have = F.split(text, r"[^a-z0-9]+")
    score = F.size(F.filter(F.array_intersect(words, have), lambda w: w != "")) + F.when(text.contains(F.lower("label")), 5).otherwise(0)
    return predicates.withColumn("score", score).orderBy(F.desc("score"), "predicate_id").limit(limit)


def request_errors(ids: Column, filters: Column, limit: Column) -> Column:
    """What is wrong with a request: exactly one of ``ids`` (array of texts) is given, one
    filter at least, and the limit is 1 to 200."""
    given = lambda a: F.size(F.filter(a, lambda x: F.coalesce(F.trim(x), F.lit("")) != ""))
    checks = [F.when(given(ids) != 1, "one_id"), F.when(given(filters) < 1, "one_filter"), F.when(~F.coalesce(limit.between(1, 200), F.lit(False)), "limit")]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def relevance(texts: DataFrame, predicates: DataFrame, limit: int) -> DataFrame:
    """(text_id, predicate_id, score) of the ``limit`` most relevant predicates of each
    text (text_id, text), as ``predicate_relevance`` scores them; predicates (predicate_id,
    label) that share no word take no part. Ties go to the lesser id.

    Texts and labels meet on words, so each pair is counted once a shared word; a label
    that stands in a text as a whole shares its words with it."""
    words = lambda c: F.filter(F.array_distinct(F.split(F.lower(c), r"[^a-z0-9]+")), lambda w: w != "")
    left = texts.select("text_id", F.explode(words("text")).alias("word"))
    right = predicates.select("predicate_id", F.explode(words("label")).alias("word"))
    shared = left.join(right, "word").groupBy("text_id", "predicate_id").agg(F.count("*").alias("n"))
    whole = shared.join(texts, "text_id").join(predicates, "predicate_id")
    score = F.col("n") + F.when(F.contains(F.lower("text"), F.lower("label")), 5).otherwise(0)
    place = F.row_number().over(Window.partitionBy("text_id").orderBy(F.desc("score"), "predicate_id"))
    scored = whole.select("text_id", "predicate_id", score.alias("score"))
    return scored.withColumn("place", place).where(F.col("place") <= limit).drop("place")
