"""Epistemic state of promoted assertions: status, corroboration and tension, each
derived for all assertions at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions import text as T


def statuses(assertions: DataFrame, dispositions: DataFrame, supersessions: DataFrame) -> DataFrame:
    """Assertions with ``status``: retracted before superseded before the latest
    disposition before active."""
    last = dispositions.groupBy("assertion_id").agg(F.max_by("target_status", F.struct("created_at", "event_id")).alias("disposition"))
    replaced = supersessions.select(F.col("prior_candidate_id").alias("candidate_id")).distinct().withColumn("replaced", F.lit(True))
    out = assertions.join(last, "assertion_id", "left").join(replaced, "candidate_id", "left")
    status = F.when(F.col("disposition") == "retracted", "retracted").when(F.col("replaced"), "superseded").otherwise(F.coalesce("disposition", F.lit("active")))
    return out.withColumn("status", status).drop("disposition", "replaced")


def superseded_by(supersessions: DataFrame, assertions: DataFrame) -> DataFrame:
    """Each replaced assertion with the assertion that replaces it."""
    a = assertions.select("candidate_id", "assertion_id")
    prior = a.select(F.col("candidate_id").alias("prior_candidate_id"), "assertion_id")
    new = a.select(F.col("candidate_id").alias("replacement_candidate_id"), F.col("assertion_id").alias("superseded_by"))
    return supersessions.join(prior, "prior_candidate_id").join(new, "replacement_candidate_id", "left")


def corroborations(snapshots: DataFrame) -> DataFrame:
    """(predicate, body, assertion_ids, n) of assertions that are active or weakened and
    say the same, two or more."""
    return (
        snapshots.where(F.col("status").isin("active", "weakened"))
        .groupBy("predicate", "body")
        .agg(F.sort_array(F.collect_list("assertion_id")).alias("assertion_ids"), F.count("*").alias("n"))
        .where("n >= 2")
    )


def corroboration_counts(snapshots: DataFrame) -> DataFrame:
    """(predicate, body, first_id, n) of the same groups, without their members."""
    live = snapshots.where(F.col("status").isin("active", "weakened"))
    return live.groupBy("predicate", "body").agg(F.min("assertion_id").alias("first_id"), F.count("*").alias("n")).where("n >= 2")


def tensions(roles: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Pairs of live assertions of one predicate that share an anchor role and differ in
    another.

    ``roles`` has (assertion_id, role_id, signature, anchored): one row for each role.
    Pairs come from an equi-join on (predicate, role, signature), so only assertions that
    share an anchor meet.
    """
    live = snapshots.where(F.col("status").isin("active", "weakened")).select("assertion_id", "predicate")
    own = roles.join(live, "assertion_id")
    maps = own.groupBy("assertion_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("role_id", "signature")))).alias("sig"))
    left = own.where("anchored").select(F.col("assertion_id").alias("a"), "predicate", "role_id", "signature")
    right = own.where("anchored").select(F.col("assertion_id").alias("b"), "predicate", "role_id", "signature")
    shared = left.join(right, ["predicate", "role_id", "signature"]).where("a < b").groupBy("predicate", "a", "b").agg(F.array_join(F.sort_array(F.collect_set("role_id")), ",").alias("anchor_roles"))
    both = shared.join(maps.select(F.col("assertion_id").alias("a"), F.col("sig").alias("sa")), "a").join(maps.select(F.col("assertion_id").alias("b"), F.col("sig").alias("sb")), "b")
    every = F.array_sort(F.array_union(F.map_keys("sa"), F.map_keys("sb")))
    differing = F.filter(every, lambda r: ~F.col("sa")[r].eqNullSafe(F.col("sb")[r]))
    key = F.concat_ws("|", "a", "b", "predicate", "anchor_roles", "differing_roles")
    out = both.withColumn("differing_roles", F.array_join(differing, ",")).where("differing_roles <> ''")
    return out.select(F.concat(F.lit("eten_"), T.short_digest(key)).alias("tension_id"), F.col("a").alias("assertion_a_id"), F.col("b").alias("assertion_b_id"), "predicate", "anchor_roles", "differing_roles")


def tension_counts(roles: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(assertion_id, tensions): with how many others each live assertion is in tension,
    without forming pairs.

    Those that share an anchor are counted by inclusion and exclusion over the sets of an
    assertion's anchored roles; those that say the same in every role are taken off.
    ``roles`` is as for ``tensions``; an assertion of r anchored roles gives 2^r - 1 rows.
    """
    live = snapshots.where(F.col("status").isin("active", "weakened")).select("assertion_id", "predicate")
    own = roles.join(live, "assertion_id").groupBy("assertion_id", "predicate").agg(
        F.array_sort(F.collect_list(F.concat_ws("=", "role_id", "signature"))).alias("every"),
        F.array_sort(F.collect_list(F.when(F.col("anchored"), F.concat_ws("=", "role_id", "signature")))).alias("anchors"),
    )
    empty = F.array(F.array().cast("array<string>"))
    subsets = F.filter(F.aggregate("anchors", empty, lambda done, r: F.concat(done, F.transform(done, lambda s: F.concat(s, F.array(r))))), lambda s: F.size(s) > 0)
    keyed = own.select("assertion_id", "predicate", F.explode(subsets).alias("s")).select("assertion_id", "predicate", F.xxhash64("s").alias("h1"), F.hash("s").alias("h2"), F.when(F.size("s") % 2 == 1, 1).otherwise(-1).alias("sign"))
    sizes = keyed.groupBy("predicate", "h1", "h2").agg(F.count("*").alias("n"))
    sharing = keyed.join(sizes, ["predicate", "h1", "h2"]).groupBy("assertion_id").agg(F.sum(F.col("sign") * F.col("n")).alias("sharing"))
    whole = own.where(F.size("anchors") > 0).select("assertion_id", "predicate", F.xxhash64("every").alias("h1"), F.hash("every").alias("h2"))
    same = whole.groupBy("predicate", "h1", "h2").agg(F.count("*").alias("same"))
    out = whole.join(same, ["predicate", "h1", "h2"]).join(sharing, "assertion_id")
    return out.select("assertion_id", (F.col("sharing") - F.col("same")).alias("tensions")).where("tensions > 0")
