"""Lineage of artifacts: registration, edges and links to candidates, each with its outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.operators.graph import closure
from factweave.sinks.events import support_is_legal


def registered(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """(artifact_id, kind, label, outcome) of artifacts to register: ``inserted``, ``unchanged``
    where the same is there, ``conflict`` where another kind or label is. Of several rows for
    one id the least is taken; a null id is left out."""
    one = incoming.where("artifact_id is not null").groupBy("artifact_id").agg(F.min(F.struct("kind", "label")).alias("new"))
    had = existing.groupBy("artifact_id").agg(F.min(F.struct("kind", "label")).alias("old"))
    rows = one.join(had, "artifact_id", "left")
    outcome = F.when(F.col("old").isNull(), "inserted").when(F.col("old").eqNullSafe(F.col("new")), "unchanged").otherwise("conflict")
    return rows.select("artifact_id", "new.kind", "new.label", outcome.alias("outcome"))


def edges(incoming: DataFrame, existing: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(parent, child, outcome) of edges to record: ``unknown_artifact`` where an end is not
    registered, ``self`` for an edge to itself, ``exists`` where it is there, ``cycle`` where
    it would close one, with what is there or with other new edges (then all new edges on it
    are refused), else ``recorded``."""
    ids = artifacts.select("artifact_id").distinct()
    new = incoming.select("parent", "child").distinct()
    ends = new.join(ids.select(F.col("artifact_id").alias("parent"), F.lit(True).alias("p")), "parent", "left").join(ids.select(F.col("artifact_id").alias("child"), F.lit(True).alias("c")), "child", "left")
    there = existing.select("parent", "child", F.lit(True).alias("there")).distinct()
    told = ends.join(there, ["parent", "child"], "left")
    sound = told.where("p and c and parent <> child").select("parent", "child").union(existing.select("parent", "child"))
    # An edge lies on a cycle where its child is an ancestor of its parent.
    above = closure(sound).select(F.col("child").alias("parent"), F.col("ancestor").alias("child"), F.lit(True).alias("round"))
    rows = told.join(above, ["parent", "child"], "left")
    outcome = F.when(F.col("p").isNull() | F.col("c").isNull(), "unknown_artifact").when(F.col("parent") == F.col("child"), "self").when(F.col("there"), "exists").when(F.col("round"), "cycle").otherwise("recorded")
    return rows.select("parent", "child", outcome.alias("outcome"))


def links(incoming: DataFrame, artifacts: DataFrame, candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """(candidate_id, artifact_id, support_kind, outcome) of links to record:
    ``unknown_candidate``, ``unknown_artifact``, ``illegal`` where the artifact's kind cannot
    support that way, ``exists`` or ``recorded``."""
    rows = incoming.select("candidate_id", "artifact_id", "support_kind").distinct()
    kinds = artifacts.groupBy("artifact_id").agg(F.min("kind").alias("kind"), F.lit(True).alias("a"))
    rows = rows.join(kinds, "artifact_id", "left").join(candidates.select("candidate_id", F.lit(True).alias("c")).distinct(), "candidate_id", "left")
    rows = rows.join(existing.select("candidate_id", "artifact_id", "support_kind", F.lit(True).alias("there")).distinct(), ["candidate_id", "artifact_id", "support_kind"], "left")
    legal = F.coalesce(support_is_legal(F.col("support_kind"), F.col("kind")), F.lit(False))
    outcome = F.when(F.col("c").isNull(), "unknown_candidate").when(F.col("a").isNull(), "unknown_artifact").when(~legal, "illegal").when(F.col("there"), "exists").otherwise("recorded")
    return rows.select("candidate_id", "artifact_id", "support_kind", outcome.alias("outcome"))
