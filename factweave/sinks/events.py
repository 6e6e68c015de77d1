"""Set-based writes to append-only tables: what a write would add, and what it would
contradict. Each returns DataFrames; ``append`` stores them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.functions import text as T


def append(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def new_rows(incoming: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first incoming row of each key that is not there yet."""
    rest = [c for c in incoming.columns if c not in keys]
    firsts = incoming.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*") if rest else incoming.distinct()
    return firsts.join(existing.select(*keys), list(keys), "left_anti")


def conflicts(incoming: DataFrame, existing: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is there with other content."""
    old = existing.select(*keys, F.struct(*content).alias("old"))
    return incoming.join(old, list(keys)).where(~F.struct(*content).eqNullSafe(F.col("old"))).drop("old")


def upsert_entities(mentions: DataFrame) -> DataFrame:
    """One row an entity: the first mention's candidate and type by ``ord``; conflict
    where two different types are named."""
    return mentions.groupBy("entity_id").agg(
        F.min_by("candidate_id", "ord").alias("first_candidate_id"),
        F.min_by(F.struct("entity_type"), "ord")["entity_type"].alias("entity_type"),
        (F.count_distinct("entity_type") > 1).alias("conflict"),
    )


def promoted(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Assertions of accepted candidates that have none yet; the id is a digest of the
    candidate's, so a repeated run adds nothing."""
    fresh = candidates.where("review_status = 'accepted'").join(existing.select("candidate_id"), "candidate_id", "left_anti")
    return fresh.select(F.concat(F.lit("gassert_"), T.short_digest(F.col("candidate_id"))).alias("assertion_id"), "candidate_id", "predicate", "source_ref")


def proposal_key(kind: str, value: str, profile: str, pack: str) -> F.Column:  # type: ignore[name-defined]
    """Digest that makes proposals of one thing one proposal."""
    return F.sha2(F.to_json(F.struct(F.col(kind).alias("kind"), F.col(profile).alias("profile"), F.col(pack).alias("target_pack"), F.col(value).alias("value"))), 256)


def keyed_insert(incoming: DataFrame, existing: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    """Each distinct incoming row with ``outcome``: ``inserted`` where its key is new,
    ``unchanged`` where it is there with the same content, ``conflict`` where it is there
    with other content or comes with several contents at once."""
    rows = incoming.select(*keys, *content).distinct()
    several = rows.groupBy(*keys).agg((F.count("*") > 1).alias("several"))
    old = existing.select(*keys, F.struct(*content).alias("old"), F.lit(True).alias("there"))
    joined = rows.join(several, list(keys)).join(old, list(keys), "left")
    same = F.struct(*content).eqNullSafe(F.col("old"))
    outcome = F.when(F.col("several") | (F.col("there").isNotNull() & ~same), "conflict").when(F.col("there").isNotNull(), "unchanged").otherwise("inserted")
    return joined.select(*keys, *content, outcome.alias("outcome"))


def membership_outcomes(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Memberships (identity_id, entity_id, membership_kind) with ``outcome``: an entity is
    in one identity at most and an identity has one canonical member at most, among the
    incoming and the existing rows together; what breaks that is a ``conflict``."""
    fresh = incoming.distinct().join(existing, ["identity_id", "entity_id", "membership_kind"], "left_anti").withColumn("new", F.lit(True))
    every = fresh.unionByName(existing.withColumn("new", F.lit(False)))
    homes = every.groupBy("entity_id").agg(F.count_distinct("identity_id").alias("homes"))
    heads = every.where("membership_kind = 'canonical'").groupBy("identity_id").agg(F.count_distinct("entity_id").alias("heads"))
    joined = fresh.join(homes, "entity_id").join(heads, "identity_id", "left")
    bad = (F.col("homes") > 1) | ((F.col("membership_kind") == "canonical") & (F.col("heads") > 1))
    return joined.select("identity_id", "entity_id", "membership_kind", F.when(bad, "conflict").otherwise("inserted").alias("outcome"))


def supersession_outcomes(incoming: DataFrame, accepted: DataFrame, existing: DataFrame) -> DataFrame:
    """Supersessions (prior_candidate_id, replacement_candidate_id) with ``outcome``: both
    must be accepted candidates (candidate_id) and differ; a prior is replaced once, and a
    candidate that replaces or is replaced takes no second part (no chains)."""
    ok = accepted.select("candidate_id").distinct()
    used = existing.select(F.col("prior_candidate_id").alias("c")).union(existing.select("replacement_candidate_id")).distinct().withColumn("used", F.lit(True))
    sides = incoming.select(F.explode(F.array(F.struct(F.col("prior_candidate_id").alias("c"), F.lit("prior").alias("side")), F.struct(F.col("replacement_candidate_id").alias("c"), F.lit("replacement").alias("side")))).alias("s")).select("s.*")
    twice = sides.groupBy("c").agg((F.count_if(F.col("side") == "prior") > 1).alias("again"), (F.count_distinct("side") > 1).alias("chained"))
    out = incoming
    for side in ("prior", "replacement"):
        key = f"{side}_candidate_id"
        out = out.join(ok.select(F.col("candidate_id").alias(key), F.lit(True).alias(f"{side}_ok")), key, "left")
        out = out.join(used.select(F.col("c").alias(key), F.col("used").alias(f"{side}_used")), key, "left")
        out = out.join(twice.select(F.col("c").alias(key), F.col("again").alias(f"{side}_again"), F.col("chained").alias(f"{side}_chained")), key)
    outcome = (
        F.when(F.col("prior_ok").isNull() | F.col("replacement_ok").isNull(), "not_accepted")
        .when(F.col("prior_candidate_id") == F.col("replacement_candidate_id"), "same")
        .when(F.col("prior_used").isNotNull() | F.col("replacement_used").isNotNull() | F.col("prior_again") | F.col("prior_chained") | F.col("replacement_chained"), "chain")
        .otherwise("inserted")
    )
    return out.select("prior_candidate_id", "replacement_candidate_id", outcome.alias("outcome"))


def reference_is_legal(status: Column, external_id: Column, note: Column, provider: Column) -> Column:
    """An attached reference has an id and no note, an unresolved one a note and no id; ids
    of wikidata are a Q and digits."""
    has_id, has_note = F.coalesce(F.trim(external_id), F.lit("")) != "", F.coalesce(F.trim(note), F.lit("")) != ""
    formed = (provider != "wikidata") | F.coalesce(external_id.rlike(r"^Q[0-9]+$"), F.lit(False))
    return F.coalesce(F.when(status == "attached", has_id & ~has_note & formed).when(status == "unresolved", has_note & ~has_id), F.lit(False))


# The kind of artifact that a candidate may be linked to in each way.
SUPPORT_KINDS = {"quoted_from": "source", "supported_by_dataset": "derived_dataset", "supported_by_analysis": "analysis_result"}


def support_is_legal(support_kind: Column, artifact_kind: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SUPPORT_KINDS.items() for x in pair])
    return F.coalesce(table[support_kind] == artifact_kind, F.lit(False))


def overlay_additions(applications: DataFrame, existing: DataFrame) -> DataFrame:
    """Lines (proposal_id, json) to append to an overlay: accepted proposals (proposal_id,
    value, policy, decision) that are to be applied and are not there yet."""
    wanted = applications.where("decision = 'accepted' and policy = 'apply_to_overlay'").join(existing.select("proposal_id"), "proposal_id", "left_anti")
    return wanted.select("proposal_id", F.to_json(F.struct(F.col("value").alias("predicate_id"), F.col("proposal_id"))).alias("json"))
