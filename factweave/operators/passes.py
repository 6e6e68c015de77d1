"""Passes of a progressive extraction between the model's answers: events to predicates, and
types of their fillers. Answers are recorded; what needs none is decided here."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.operators.extract import assign_slots
from factweave.operators.graph import closure
from factweave.storage import cut

#: Constraints that narrow nothing.
TRIVIAL = ("Entity",)
_ROLES = "map<string,string>"


def mapped(events: DataFrame, senses: DataFrame, answers: DataFrame, families: Mapping[str, list[str]]) -> DataFrame:
    """(event_id, predicate_id, roles, method, confidence) of ``events`` (event_id, verb,
    participants: array of (proto_role, name)).

    A verb is looked up among ``senses`` (lemma, predicate_id, sense_id, confidence, slots)
    by its forms, the first that is there. One sense is taken as it is, its slots filled by
    ``assign_slots`` (``single_sense``). Of several the recorded answer (event_id, response:
    JSON, fenced or not, with predicate_id and role_mapping) picks one by its predicate or
    sense id (``picked``). What has no sense, no answer, or one that names none of the
    senses is ``unresolved``, with null predicate. Verbs are looked up once each."""
    lexicon = cut(senses.where("lemma is not null").groupBy("lemma").agg(F.array_sort(F.collect_list(F.struct("predicate_id", "sense_id", "confidence", "slots"))).alias("senses")))
    verbs = events.select("verb").where("verb is not null").distinct().select("verb", F.posexplode(T.lemma_candidates(F.col("verb"))).alias("pos", "lemma"))
    known = verbs.join(lexicon.select("lemma"), "lemma").groupBy("verb").agg(F.min_by("lemma", "pos").alias("lemma"))
    told = events.join(known, "verb", "left").join(lexicon, "lemma", "left").join(answers.groupBy("event_id").agg(F.min("response").alias("response")), "event_id", "left")
    bare = F.regexp_replace(F.regexp_replace(F.trim("response"), r"\A```[^\n]*\n", ""), r"\n?```\s*\z", "")
    wanted, one = F.get_json_object(bare, "$.predicate_id"), F.get("senses", F.lit(0))
    by_id, by_sense = F.filter("senses", lambda s: s["predicate_id"] == F.col("wanted")), F.filter("senses", lambda s: s["sense_id"] == F.col("wanted"))
    rows = told.withColumn("wanted", wanted).withColumn("n", F.coalesce(F.when(F.size("senses") > 0, F.size("senses")), F.lit(0)))
    rows = rows.withColumn("chosen", F.when(F.col("n") == 1, one).when(F.col("n") > 1, F.coalesce(F.get(by_id, F.lit(0)), F.get(by_sense, F.lit(0)))))
    labels = assign_slots(F.col("participants"), F.col("chosen.slots"), families)
    pairs = F.filter(F.zip_with(labels, "participants", lambda s, p: F.struct(s.alias("key"), p["name"].alias("value"))), lambda e: e["key"].isNotNull())
    roles = F.when(F.col("chosen").isNull(), F.create_map().cast(_ROLES)).when(F.col("n") == 1, F.coalesce(F.map_from_entries(pairs), F.create_map().cast(_ROLES))).otherwise(F.coalesce(F.from_json(F.get_json_object(bare, "$.role_mapping"), _ROLES), F.create_map().cast(_ROLES)))
    method = F.when(F.col("chosen").isNull(), "unresolved").when(F.col("n") == 1, "single_sense").otherwise("picked")
    return rows.select("event_id", F.col("chosen.predicate_id").alias("predicate_id"), roles.alias("roles"), method.alias("method"), F.when(F.col("chosen").isNotNull(), F.coalesce("chosen.confidence", F.lit(0.5))).alias("confidence"))


def refined(fillers: DataFrame, edges: DataFrame, answers: DataFrame) -> DataFrame:
    """(event_id, role, refined_type, method) of ``fillers`` (event_id, role, coarse_type,
    constraint), types being in a hierarchy of ``edges`` (child, parent).

    A type without subtypes stays (``leaf_early_exit``). Else an answer (event_id, role,
    refined_type) counts if it is the coarse type or below it and, where the role's
    constraint shares a type with that subtree (``subtree_pick``), the constraint or below
    it too; a constraint that is null, trivial, unknown or elsewhere narrows nothing
    (``no_constraint``). Without an answer that counts the coarse type stays. No list of
    candidates is formed for a filler: types are looked up in the closure."""
    above = cut(closure(edges))
    types = edges.select(F.col("child").alias("t")).union(edges.select("parent")).where("t is not null").distinct()
    below = cut(above.select(F.col("ancestor").alias("top"), F.col("child").alias("t")).union(types.select(F.col("t").alias("top"), "t")))
    inner = edges.select(F.col("parent").alias("coarse_type"), F.lit(True).alias("inner")).distinct()
    # Pairs of a coarse type and a constraint, each once, that share a type.
    pairs = fillers.select("coarse_type", "constraint").where("constraint is not null").where(~F.col("constraint").isin(*TRIVIAL)).distinct()
    left, right = below.select(F.col("top").alias("coarse_type"), "t"), below.select(F.col("top").alias("constraint"), "t")
    shared = pairs.join(left, "coarse_type").join(right, ["constraint", "t"]).select("coarse_type", "constraint", F.lit(True).alias("narrow")).distinct()
    told = fillers.join(answers.groupBy("event_id", "role").agg(F.min("refined_type").alias("answer")), ["event_id", "role"], "left").join(inner, "coarse_type", "left").join(shared, ["coarse_type", "constraint"], "left")
    told = told.join(below.select(F.col("top").alias("coarse_type"), F.col("t").alias("answer"), F.lit(True).alias("in_coarse")), ["coarse_type", "answer"], "left")
    told = told.join(below.select(F.col("top").alias("constraint"), F.col("t").alias("answer"), F.lit(True).alias("in_constraint")), ["constraint", "answer"], "left")
    legal = F.coalesce((F.col("in_coarse") | (F.col("answer") == F.col("coarse_type"))) & (F.col("narrow").isNull() | F.col("in_constraint")), F.lit(False))
    method = F.when(F.col("inner").isNull(), "leaf_early_exit").when(F.col("narrow"), "subtree_pick").otherwise("no_constraint")
    return told.select("event_id", "role", F.when(F.col("inner").isNotNull() & legal, F.col("answer")).otherwise(F.col("coarse_type")).alias("refined_type"), method.alias("method"))
