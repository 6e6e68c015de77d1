"""Exports: graph rows as JSON lines, assertions as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(rows: DataFrame, path: str, files: int | None = None) -> None:
    """JSON lines with keys in alphabetical order and nulls kept; ``files`` only for
    results known to be small."""
    out = rows.select(*sorted(rows.columns))
    (out.coalesce(files) if files else out).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def relationships(fillers: DataFrame) -> DataFrame:
    """Binary edges of assertions: the first entity of ARG0 and of ARG1, else of the first
    two roles by name. ``fillers`` has (assertion_id, predicate, role_id, filler_index,
    entity_id)."""
    firsts = fillers.groupBy("assertion_id", "predicate", "role_id").agg(F.min_by("entity_id", "filler_index").alias("e"))
    roles = firsts.groupBy("assertion_id", "predicate").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("role_id", "e")))).alias("m"))
    keys = F.array_sort(F.map_keys("m"))
    rest = F.filter(keys, lambda k: ~k.isin("ARG0", "ARG1"))
    source = F.coalesce(F.col("m")["ARG0"], F.col("m")[F.get(rest, F.lit(0))], F.lit(""))
    target = F.coalesce(F.col("m")["ARG1"], F.col("m")[F.get(rest, F.when(F.col("m")["ARG0"].isNull(), 1).otherwise(0))], F.lit(""))
    return roles.select("assertion_id", F.col("predicate").alias("relation_name"), source.alias("src_id"), target.alias("tgt_id"))


def assertion_json(assertions: DataFrame, fillers: DataFrame) -> DataFrame:
    """(assertion_id, json) with roles nested and nulls dropped."""
    roles = fillers.groupBy("assertion_id", "role_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("filler_index", "entity_id"))), lambda s: s["entity_id"]).alias("e"))
    nested = roles.groupBy("assertion_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("role_id", "e")))).alias("roles"))
    both = assertions.join(nested, "assertion_id", "left")
    return both.select("assertion_id", F.to_json(F.struct("assertion_id", "predicate", "roles", F.array(F.col("candidate_id")).alias("provenance_refs"))).alias("json"))


def json_rows(rows: DataFrame) -> DataFrame:
    """(value): each row as one JSON text with keys in alphabetical order, nulls kept."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("value"))


def chunk_files(chunks: DataFrame, key: str, path: str) -> DataFrame:
    """Write chunks (key, chunk_id, char_start, char_end, content, ..) and their manifest
    below ``path``, which must not be there yet; the manifest as it stands on disk."""
    chunks.write.mode("errorifexists").json(f"{path}/chunks")
    manifest = chunks.select(key, "chunk_id", "char_start", "char_end", F.sha2("content", 256).alias("sha256"))
    manifest.write.mode("errorifexists").json(f"{path}/manifest")
    return chunks.sparkSession.read.schema(manifest.schema).json(f"{path}/manifest")


def role_labels(slots: DataFrame) -> DataFrame:
    """(predicate, labels): for each predicate of ``slots`` (predicate, slot, label) a JSON
    object of its slots' labels, in order of the slots. A blank label is left out, a
    predicate without one too; of several labels of a slot the least is taken."""
    told = slots.where(F.trim(F.coalesce("label", F.lit(""))) != "").groupBy("predicate", "slot").agg(F.min(F.trim("label")).alias("label"))
    return told.groupBy("predicate").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("slot", "label"))))).alias("labels"))
