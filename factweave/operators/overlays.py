"""Overlays of ontology packs: accepted proposals applied to them, and what was applied."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions.text import short_digest
from factweave.operators.review import proposal_states


def applied(proposals: DataFrame, reviews: DataFrame, content: DataFrame, applications: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to append to an overlay's ``content`` (pack, predicate_id, label, proposal_id) and
    to its ``applications`` (application_id, proposal_id, pack, predicate_id).

    Applied is a proposal (proposal_id, pack, value, policy) that is accepted, whose policy
    asks for it and that was not applied before. Of several for one predicate of a pack the
    least adds it, and the others are applications of what is there already; so is one
    whose predicate the overlay holds. Applying again adds nothing."""
    states = proposal_states(proposals.select("proposal_id", "policy"), reviews, applications).where("application_status = 'pending_overlay_apply'")
    due = proposals.join(states.select("proposal_id"), "proposal_id", "left_semi").withColumn("predicate_id", F.regexp_replace(F.lower(F.trim("value")), r"[^a-z0-9:]+", "_"))
    due = due.where(F.col("predicate_id") != "")
    first = due.groupBy("pack", "predicate_id").agg(F.min_by(F.struct("proposal_id", "value"), "proposal_id").alias("f"))
    lines = first.join(content.select("pack", "predicate_id").distinct(), ["pack", "predicate_id"], "left_anti").select("pack", "predicate_id", F.trim("f.value").alias("label"), "f.proposal_id")
    made = due.select(F.concat(F.lit("oapp_"), short_digest(F.concat_ws("|", "pack", "predicate_id", "proposal_id"))).alias("application_id"), "proposal_id", "pack", "predicate_id")
    return lines, made


def listed(applications: DataFrame, pack: str | None = None) -> DataFrame:
    """Applications with ``place``: their order by predicate and proposal inside their pack."""
    rows = applications if pack is None else applications.where(F.col("pack") == pack)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("pack").orderBy("predicate_id", "proposal_id")).cast("long"))
