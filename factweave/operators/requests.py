"""Requests as SQL functions that return tables: a caller of SQL asks by id, the id reaches
the scan, and an id that is not there is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Body of each function over the views it names; ``wanted`` is its parameter.
FUNCTIONS = {
    "candidate_detail": (
        "candidate_id STRING, predicate STRING, review_status STRING, validation_status STRING, source_ref STRING",
        "SELECT candidate_id, predicate, review_status, validation_status, source_ref FROM fw_candidates WHERE candidate_id = wanted",
        "candidate",
    ),
    "source_detail": (
        "source_ref STRING, candidates BIGINT, accepted BIGINT, predicates ARRAY<STRING>",
        "SELECT source_ref, count(*), count_if(review_status = 'accepted'), array_sort(collect_set(predicate)) FROM fw_candidates WHERE source_ref = wanted GROUP BY source_ref",
        "source",
    ),
    "assertion_bundle": (
        "assertion_id STRING, predicate STRING, candidate_id STRING, confidence DOUBLE, fillers ARRAY<STRUCT<role_id: STRING, filler_index: BIGINT, entity_id: STRING>>",
        """SELECT a.assertion_id, a.predicate, a.candidate_id, c.confidence_score, f.fillers FROM (SELECT * FROM fw_assertions WHERE assertion_id = wanted) a
 LEFT JOIN fw_confidences c ON c.candidate_id = a.candidate_id
 LEFT JOIN (SELECT assertion_id, array_sort(collect_list(struct(role_id, filler_index, entity_id))) AS fillers FROM fw_fillers WHERE assertion_id = wanted GROUP BY assertion_id) f ON f.assertion_id = a.assertion_id""",
        "assertion",
    ),
}


def register(spark: SparkSession, candidates: DataFrame, assertions: DataFrame, fillers: DataFrame, confidences: DataFrame) -> None:
    """Make the functions of FUNCTIONS known to the session, over these tables.

    Each takes one text. Where its rows are none, it raises with the kind and the text; a
    null text raises too."""
    for name, frame in (("candidates", candidates), ("assertions", assertions), ("fillers", fillers), ("confidences", confidences)):
        frame.createOrReplaceTempView(f"fw_{name}")
    for name, (columns, body, kind) in FUNCTIONS.items():
        fields = [c.strip().split(" ")[0] for c in _split(columns)]
        first, rest = fields[0], fields[1:]
        nothing = ", ".join(["raise_error(concat('" + kind + " not found: ', coalesce(wanted, 'null')))", *["NULL"] * len(rest)])
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted STRING) RETURNS TABLE({columns})
 RETURN WITH found({", ".join(fields)}) AS ({body}) SELECT * FROM found UNION ALL SELECT {nothing} FROM (SELECT count({first}) AS n FROM found) WHERE n = 0"""
        )


def _split(columns: str) -> list[str]:
    """Column definitions, cut at commas outside of brackets."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(columns):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(columns[start:i])
            start = i + 1
    return [*out, columns[start:]]
