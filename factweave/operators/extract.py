"""Deterministic shells of extraction: alias pairs, slots, rewrites, diffs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions import text as T

# Forms of a declared alias, long name first or short name first.
LONG_FIRST = r"\b([A-Z][^\(\)\n]{4,80}?)\s+\(([A-Z][A-Z0-9\-]{1,15})\)"
SHORT_FIRST = r"\b([A-Z][A-Z0-9\-]{1,15})\s+\(([A-Z][^\(\)\n]{4,80}?)\)"


def alias_pairs(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, short, long) declared in a text as "Long Name (LN)" or "LN (Long Name)" where
    both are known names (name); a leading article of the long form may be left out."""

    def found(pattern: str, long: int, short: int) -> Column:
        both = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), long).alias("l"), F.regexp_extract_all(text, F.lit(pattern), short).alias("s"))
        return F.transform(both, lambda p: F.struct(F.trim(p["l"]).alias("long"), F.trim(p["s"]).alias("short")))

    rows = docs.select(F.col(key), F.explode(F.concat(found(LONG_FIRST, 1, 2), found(SHORT_FIRST, 2, 1))).alias("p")).select(key, "p.*")
    forms = rows.select(key, "short", F.explode(F.array(F.struct(F.lit(0).alias("cut"), F.col("long").alias("form")), F.struct(F.lit(1).alias("cut"), F.regexp_replace("long", "^(?:The|A|An) ", "").alias("form")))).alias("f"), "long")
    known = forms.select(key, "short", "long", "f.*").join(names.select(F.col("name").alias("form")).distinct(), "form", "left_semi").join(names.select(F.col("name").alias("short")).distinct(), "short", "left_semi")
    return known.groupBy(key, "short", "long").agg(F.min_by("form", "cut").alias("form")).select(key, "short", F.col("form").alias("long")).distinct()


def assign_slots(participants: Column, slots: Column, families: Mapping[str, list[str]]) -> Column:
    """Slot of each participant (array of structs with proto_role): in order, the first
    free slot of its role's family, else the first free one, else null. ``slots`` is an
    array of labels."""
    table = F.create_map(*[x for k, v in families.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]) if families else F.create_map().cast("map<string,array<string>>")

    def step(done: Column, p: Column) -> Column:
        free = F.filter(slots, lambda s: ~F.array_contains(F.filter(done, lambda d: d.isNotNull()), s))
        family = F.coalesce(table[p["proto_role"]], F.array().cast("array<string>"))
        fits = F.filter(free, lambda s: F.array_contains(family, s) | (s == p["proto_role"]))
        return F.concat(done, F.array(F.coalesce(F.get(fits, F.lit(0)), F.get(free, F.lit(0)))))

    return F.aggregate(participants, F.array().cast("array<string>"), step)


def rewrite_names(mentions: DataFrame, renames: DataFrame) -> DataFrame:
    """Mentions (name, ..) under their canonical names; ``renames`` has (name, target), a
    null target drops the mention."""
    table = renames.select("name", F.struct("target").alias("t"))
    out = mentions.join(table, "name", "left").where("t is null or t.target is not null")
    return out.withColumn("name", F.coalesce("t.target", "name")).drop("t")


def map_diff(left: Column, right: Column) -> Column:
    """Keys whose values differ, with both values."""
    both = F.map_zip_with(left, right, lambda k, a, b: F.struct(a.alias("left"), b.alias("right")))
    return F.map_filter(both, lambda k, v: ~v["left"].eqNullSafe(v["right"]))


def coerced_events(raw: DataFrame) -> DataFrame:
    """Strict events of permissive ones (verb, participants, confidence, claim_level,
    ..): those without a verb or a named participant go; blank roles and types get their
    defaults, confidence is held to 0..1 and an unknown level is ``instance``.
    ``participants`` is an array of structs (proto_role, name, coarse_type)."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    named = F.filter("participants", lambda p: ~blank(p["name"]))
    strict = F.transform(named, lambda p: F.struct(F.when(blank(p["proto_role"]), "Unspecified").otherwise(F.trim(p["proto_role"])).alias("proto_role"), F.trim(p["name"]).alias("name"), F.when(blank(p["coarse_type"]), "Entity").otherwise(F.trim(p["coarse_type"])).alias("coarse_type")))
    kept = raw.where(~blank(F.col("verb"))).withColumn("verb", F.trim("verb")).withColumn("participants", F.coalesce(strict, F.array().cast("array<struct<proto_role:string,name:string,coarse_type:string>>")))
    level = F.when(F.col("claim_level").isin("type", "instance"), F.col("claim_level")).otherwise("instance")
    return kept.where(F.size("participants") > 0).withColumns({"confidence": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("confidence"))), "claim_level": level})


def typed_roles(participants: Column, refinements: Column) -> Column:
    """Role -> (name, type) of typed participants (slot, name, coarse_type): the first
    refinement (name, refined_type) of a name gives its type, else the coarse one stands.
    Without slots the first two are source_entity and target_entity."""

    def typed(p: Column) -> Column:
        first = F.get(F.filter(refinements, lambda r: r["name"] == p["name"]), F.lit(0))
        return F.struct(p["name"].alias("name"), F.coalesce(first["refined_type"], p["coarse_type"]).alias("entity_type"))

    slotted = F.filter(participants, lambda p: p["slot"].isNotNull())
    fallback = F.slice(participants, 1, 2)
    names = F.array(F.lit("source_entity"), F.lit("target_entity"))
    by_slot = F.map_from_entries(F.transform(slotted, lambda p: F.struct(p["slot"], typed(p))))
    by_place = F.map_from_arrays(F.slice(names, F.lit(1), F.size(fallback)), F.transform(fallback, typed))
    return F.when(F.size(slotted) > 0, by_slot).otherwise(by_place)


def gloss(roles: Column, sense: Column) -> Column:
    """"Agent [sense] Theme" of a map role -> name, else its first two names by role."""
    agent, theme = F.try_element_at(roles, F.lit("Agent")), F.try_element_at(roles, F.lit("Theme"))
    names = F.transform(F.slice(F.array_sort(F.map_keys(roles)), 1, 2), lambda k: roles[k])
    return F.when(agent.isNotNull() & theme.isNotNull(), F.concat(agent, F.lit(" ["), sense, F.lit("] "), theme)).otherwise(F.concat(F.lit("["), sense, F.lit("] "), F.array_join(names, ", ")))


def coreferences(mentions: DataFrame) -> DataFrame:
    """Mentions (doc_id, place, name) with ``target``: a certain anaphor stands for the
    last name before it in its document that is none, other mentions for themselves; null
    where nothing stands before."""
    marked = mentions.withColumn("own", F.when(~T.anaphor(F.col("name"))["is_certain"], F.col("name")))
    before = F.last("own", ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("place"))
    return marked.withColumn("target", F.coalesce("own", before)).drop("own")
