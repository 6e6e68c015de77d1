"""Claims to assertions in one flow: submit, validate, propose, accept, promote, resolve.

``claims`` has (claim_id, predicate, source_ref, source_text, span_start, span_end,
span_text); ``fillers`` (claim_id, role_id, filler_index, entity_id, name), all of them
entities. Every step is a function of tables, and ids are digests of content, so a
repeated step writes the same rows and adds none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions import payload
from factweave.functions import text as T
from factweave.operators import identity, review, validate
from factweave.sinks import events, export


def payloads(claims: DataFrame, fillers: DataFrame) -> DataFrame:
    """Claims with ``payload_json`` (sorted keys, no spaces) and ``payload_hash``."""
    entity = F.struct(F.col("entity_id"), F.lit("entity").alias("kind"), F.col("name"))
    # Dealt out by claim, fillers and then their roles are gathered in one shuffle.
    by_role = fillers.repartition("claim_id").groupBy("claim_id", "role_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("filler_index", entity.alias("f")))), lambda x: x["f"]).alias("fillers"))
    roles = by_role.groupBy("claim_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("role_id", "fillers")))).alias("roles"))
    body = F.to_json(F.struct(F.col("predicate"), F.col("roles")))
    return claims.join(roles, "claim_id", "left").withColumn("payload_json", body).withColumn("payload_hash", F.concat(F.lit("sha256:"), F.sha2("payload_json", 256)))


def submit(claims: DataFrame, fillers: DataFrame, profile: validate.Profile) -> DataFrame:
    """Candidates: claims with ``candidate_id``, ``payload_hash``, ``span_ok`` and
    ``validation_status``. A claim with a wrong span is kept and marked; it is never
    accepted."""
    known = payloads(claims, fillers)
    heads = known.select(F.col("claim_id").alias("payload_id"), "predicate")
    entity = fillers.select(F.col("claim_id").alias("payload_id"), "role_id", F.col("filler_index").alias("idx"), F.lit("entity").alias("kind"), "entity_id", F.lit(None).cast("string").alias("entity_type"), F.lit(None).cast("string").alias("value_kind"))
    roles = entity.groupBy("payload_id", "role_id").agg(F.count("*").alias("n"))
    found = validate.outcomes(heads, validate.findings(heads, roles, entity, profile)).select(F.col("payload_id").alias("claim_id"), F.col("status").alias("validation_status"), "codes")
    ident = F.concat(F.lit("cand_"), T.short_digest(F.concat_ws("|", "source_ref", F.col("claim_id").cast("string"), "payload_hash")))
    ok = F.coalesce(payload.span_ok(F.col("source_text"), F.col("span_start"), F.col("span_end"), F.col("span_text")), F.lit(False))
    return known.join(found, "claim_id").select(ident.alias("candidate_id"), "claim_id", "predicate", "source_ref", "payload_hash", ok.alias("span_ok"), "validation_status", "codes")


def proposals(candidates: DataFrame, profile: validate.Profile, profile_id: str, pack: str) -> DataFrame:
    """(proposal_key, value, first_candidate_id, n) of predicates the profile does not
    know; one proposal a predicate, however many candidates name it."""
    unknown = candidates.join(profile.allowed.select("predicate").distinct(), "predicate", "left_anti").withColumns({"profile": F.lit(profile_id), "pack": F.lit(pack), "kind": F.lit("predicate")})
    keyed = unknown.withColumn("proposal_key", events.proposal_key("kind", "predicate", "profile", "pack"))
    return keyed.groupBy("proposal_key", F.col("predicate").alias("value")).agg(F.min("candidate_id").alias("first_candidate_id"), F.count("*").alias("n"))


def accept_all(candidates: DataFrame) -> DataFrame:
    """Candidates with ``review_status``: accepted where span and validation allow it,
    rejected for a wrong span, else pending."""
    legal = review.review_is_legal(F.lit("pending_review"), F.col("validation_status"), F.lit("accepted"))
    return candidates.withColumn("review_status", F.when(~F.col("span_ok"), "rejected").when(legal, "accepted").otherwise("pending_review"))


def promote(reviewed: DataFrame, existing: DataFrame) -> DataFrame:
    """New assertions of accepted candidates; ``existing`` has the candidate_id of those
    promoted before."""
    return events.promoted(reviewed, existing)


def resolved(entities: DataFrame) -> DataFrame:
    """(entity_id, canonical) of entities (entity_id, name, ord) by exact name."""
    groups = identity.group_exact(entities).select("name_key", "canonical")
    return entities.withColumn("name_key", T.normalize_name(F.col("name"))).join(groups, "name_key").select("entity_id", "canonical")


def exported(assertions: DataFrame, candidates: DataFrame, fillers: DataFrame, canonical: DataFrame) -> DataFrame:
    """Binary edges (assertion_id, relation_name, src_id, tgt_id) between canonical
    entities."""
    keys = assertions.select("assertion_id", "candidate_id", "predicate").join(candidates.select("candidate_id", "claim_id"), "candidate_id")
    # An edge takes the first filler of a role alone, so no other is resolved.
    firsts = fillers.groupBy("claim_id", "role_id").agg(F.min_by("entity_id", "filler_index").alias("entity_id"), F.min("filler_index").alias("filler_index"))
    rows = firsts.join(keys, "claim_id").join(canonical, "entity_id", "left").select("assertion_id", "predicate", "role_id", "filler_index", F.coalesce("canonical", "entity_id").alias("entity_id"))
    return export.relationships(rows)
