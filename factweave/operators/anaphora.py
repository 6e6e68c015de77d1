"""References to propositions: what an anaphor stands for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.operators.graph import pointed


def antecedents(mentions: DataFrame) -> DataFrame:
    """(doc_id, id, antecedent) of each anaphor of ``mentions`` (doc_id, offset, id,
    anaphor, target): the proposition that it stands for, null if there is none.

    An anaphor points at its recorded ``target``, another mention of its document; without
    one, or where the target is no mention there, at the last proposition before it
    (an as-of join by offset; of one offset the greater id counts as later). Anaphors may
    point at anaphors: chains of any length are followed to their ends, and one that comes
    back to itself raises. Ids are unique in a document; rows with a null id or document
    are left out.
    """
    rows = mentions.where("id is not null and doc_id is not null")
    # One document's mentions are as many as one text gives.
    before = Window.partitionBy("doc_id").orderBy("offset", "id").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("nearest", F.last(F.when(~F.col("anaphor"), F.col("id")), ignorenulls=True).over(before))
    known = rows.select("doc_id", F.col("id").alias("target"), F.lit(True).alias("there"))
    asked = placed.where("anaphor").join(known, ["doc_id", "target"], "left").select("doc_id", "id", F.coalesce(F.when(F.col("there"), F.col("target")), "nearest").alias("to"))
    node = lambda c: F.struct("doc_id", F.col(c).alias("id"))
    ends = pointed(asked.where("to is not null").select(node("id").alias("id"), node("to").alias("target"))).select("id.doc_id", "id.id", F.col("end.id").alias("end"))
    reached = asked.select("doc_id", "id").join(ends, ["doc_id", "id"], "left")
    propositions = rows.where(~F.col("anaphor")).select("doc_id", F.col("id").alias("end"), F.col("id").alias("antecedent"))
    return reached.join(propositions, ["doc_id", "end"], "left").select("doc_id", "id", "antecedent")
