"""Review state as append-only events: joins, guards and derived statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Allowed changes of an assertion's epistemic status.
TRANSITIONS = {"active": ("weakened", "retracted"), "weakened": ("active", "retracted"), "superseded": (), "retracted": ()}


def with_review(candidates: DataFrame, reviews: DataFrame) -> DataFrame:
    """Candidates with their review, if any."""
    return candidates.join(reviews, "candidate_id", "left")


def having_status(items: DataFrame, links: DataFrame, key: str, status: str) -> DataFrame:
    """Items with at least one linked row of that status."""
    return items.join(links.where(F.col("status") == status).select(key), key, "left_semi")


def validation_status(hard: Column, soft: Column) -> Column:
    return F.when(hard > 0, "invalid").when(soft > 0, "needs_review").otherwise("valid")


def review_is_legal(review_status: Column, validation: Column, decision: Column, permissive: bool = False) -> Column:
    """Only pending candidates are reviewed; an invalid one is not accepted unless the
    profile is permissive."""
    return (review_status == "pending_review") & (F.lit(permissive) | (decision != "accepted") | (validation != "invalid"))


def application_status(decision: Column, policy: Column) -> Column:
    """Whether an accepted proposal is still to be applied to an overlay."""
    return F.when(decision == "rejected", "not_requested").when(policy == "record_only", "recorded").otherwise("pending_overlay_apply")


def unknown_item_action(kind_override: Column, default: Column, mode: Column) -> Column:
    """What to do with an item the profile does not know: the rule of its kind, else the
    profile's default, else what its mode says."""
    by_mode = F.when(mode == "open", "allow").when(mode == "closed", "reject").when(mode == "mixed", "propose")
    return F.coalesce(kind_override, default, by_mode)


def transition_is_legal(current: Column, target: Column) -> Column:
    out = F.lit(False)
    for status, targets in TRANSITIONS.items():
        if targets:
            out = F.when(current == status, target.isin(*targets)).otherwise(out)
    return out


def verdict(rate: Column, positive: float = 0.75, negative: float = 0.25) -> Column:
    return F.when(rate >= positive, "positive").when(rate <= negative, "negative").otherwise("mixed")


def latest(events: DataFrame, key: str, *order: str) -> DataFrame:
    """The last event of each key in ``order``, as one aggregation without a sort."""
    rest = [c for c in events.columns if c != key]
    return events.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("e")).select(key, "e.*")


def bundles(candidates: DataFrame, links: DataFrame, proposals: DataFrame, applications: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Candidates (candidate_id, ..) with their proposals as sorted arrays of structs
    (proposal_id, decision, applied) and their artifacts (artifact_id, support_kind).

    ``links`` has (candidate_id, proposal_id), ``proposals`` (proposal_id, decision),
    ``applications`` (proposal_id), ``artifacts`` (candidate_id, artifact_id,
    support_kind). A candidate without any has empty arrays."""
    applied = applications.select("proposal_id").distinct().withColumn("applied", F.lit(True))
    state = proposals.join(applied, "proposal_id", "left").select("proposal_id", "decision", F.coalesce("applied", F.lit(False)).alias("applied"))
    mine = links.distinct().join(state, "proposal_id").groupBy("candidate_id").agg(F.sort_array(F.collect_list(F.struct("proposal_id", "decision", "applied"))).alias("proposals"))
    own = artifacts.distinct().groupBy("candidate_id").agg(F.sort_array(F.collect_list(F.struct("artifact_id", "support_kind"))).alias("artifacts"))
    out = candidates.join(mine, "candidate_id", "left").join(own, "candidate_id", "left")
    return out.withColumns({"proposals": F.coalesce("proposals", F.array().cast(mine.schema["proposals"].dataType)), "artifacts": F.coalesce("artifacts", F.array().cast(own.schema["artifacts"].dataType))})


def proposal_states(proposals: DataFrame, reviews: DataFrame, applications: DataFrame) -> DataFrame:
    """Proposals (proposal_id, policy, ..) with the latest review's decision, ``status``
    (pending, accepted, rejected) and ``application_status``: applied where an application
    is recorded, else what decision and policy ask for."""
    last = reviews.groupBy("proposal_id").agg(F.max_by("decision", F.struct("reviewed_at", "review_id")).alias("decision"))
    done = applications.select("proposal_id").distinct().withColumn("done", F.lit(True))
    out = proposals.join(last, "proposal_id", "left").join(done, "proposal_id", "left")
    asked = F.when(F.col("decision").isNotNull(), application_status(F.col("decision"), F.col("policy")))
    return out.withColumns({"status": F.coalesce("decision", F.lit("pending")), "application_status": F.when(F.col("done"), "applied").otherwise(asked)}).drop("done")


def requested(rows: DataFrame, ids: list[str], key: str) -> DataFrame:
    """The rows of explicit ids, each with its ``place`` in the request; an id without a
    row, or asked for twice, is an error."""
    if len(set(ids)) != len(ids):
        raise ValueError("an id is asked for twice")
    wanted = rows.sparkSession.createDataFrame(list(enumerate(ids)), f"place int, {key} string")
    found = rows.join(F.broadcast(wanted), key)
    have = {r[0] for r in found.select(key).distinct().collect()}
    if len(have) < len(ids):
        raise LookupError(f"not found: {sorted(set(ids) - have)}")
    return found


def appended(requests: DataFrame, candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """``requests`` (request_id, candidate_id, decision, actor_id, requested_at) with
    ``outcome``: which reviews are recorded.

    The first legal request of a candidate without a review is ``recorded``; later ones, and
    those of a candidate that has one (``existing``: candidate_id), are
    ``already_reviewed``; to accept what is invalid is ``illegal``; a candidate that is not
    in ``candidates`` (candidate_id, validation_status) is ``unknown``. Requests count in
    order of time and id, so a retry of the same requests gives the same."""
    known = candidates.select("candidate_id", "validation_status").dropDuplicates(["candidate_id"])
    rows = requests.join(known.withColumn("_known", F.lit(True)), "candidate_id", "left").join(existing.select("candidate_id", F.lit(True).alias("_had")).distinct(), "candidate_id", "left")
    legal = F.coalesce(F.col("_known") & review_is_legal(F.lit("pending_review"), F.col("validation_status"), F.col("decision")), F.lit(False))
    rows = rows.withColumn("_legal", legal)
    first = rows.where(F.col("_legal") & F.col("_had").isNull()).groupBy("candidate_id").agg(F.min(F.struct("requested_at", "request_id")).alias("_first"))
    told = rows.join(first, "candidate_id", "left")
    outcome = (
        F.when(F.col("_known").isNull(), "unknown").when(F.col("_had").isNotNull(), "already_reviewed").when(~F.col("_legal"), "illegal")
        .when(F.struct("requested_at", "request_id") == F.col("_first"), "recorded").otherwise("already_reviewed")
    )
    return told.select(*requests.columns, outcome.alias("outcome"))
