"""Evaluation: ancestor scores, multiset matches, aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ancestor_score(picked: Column, wanted: Column, depth_picked: Column, depth_wanted: Column, relation: Column, base: float = 0.8) -> Column:
    """Score of a picked type against the wanted one: 1 if equal; less the coarser or the
    finer it is on one branch; 0 on another branch. ``relation`` is 'coarser' when picked
    is an ancestor of wanted, 'finer' the other way round."""
    coarser = base * F.greatest((depth_picked + 1) / (depth_wanted + 1), F.lit(0.05))
    finer = F.least(F.lit(1.0), base + (1 - base) * (1 - F.when(depth_picked > 0, depth_wanted / depth_picked).otherwise(1.0)))
    return F.when(picked == wanted, 1.0).when(relation == "coarser", coarser).when(relation == "finer", finer).otherwise(0.0)


def multiset_match(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, expected, observed, matched) by signature; a signature matches as often as it
    stands on both sides."""
    e = expected.groupBy(*keys).agg(F.count("*").alias("n_expected"))
    o = observed.groupBy(*keys).agg(F.count("*").alias("n_observed"))
    out = e.join(o, keys, "full").na.fill(0, ["n_expected", "n_observed"])
    return out.withColumn("n_matched", F.least("n_expected", "n_observed"))


def precision_recall(matched: Column, expected: Column, observed: Column, empty: float = 0.0) -> tuple[Column, Column, Column]:
    """Precision, recall and F1 with ``empty`` where nothing was expected or observed."""
    p = F.when(observed == 0, F.lit(empty)).otherwise(matched / observed)
    r = F.when(expected == 0, F.lit(empty)).otherwise(matched / expected)
    return p, r, F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r))


def trial_score(f1: Column, usable: Column, alignment: Column) -> Column:
    return 0.65 * f1 + 0.25 * usable + 0.10 * alignment


def compared_calls(live: DataFrame, trial: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, equal) of calls that both tables hold, one row a key each; two nulls
    are equal."""
    left = live.select(key, *[F.col(c).alias(f"l_{c}") for c in fields])
    both = left.join(trial.select(key, *[F.col(c).alias(f"r_{c}") for c in fields]), key)
    marks = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")).alias("equal")) for c in fields])
    return both.select(key, F.explode(marks).alias("m")).select(key, "m.*")


# Buckets of a failed trial and the marks of each, in the order they are tried.
FAILURES = {
    "insufficient_credits": ["requires more credits", '"code":402'],
    "provider_schema_rejected": ["invalid_json_schema", "invalid schema for response_format", "provider rejected structured json-schema output"],
    "provider_invalid_arguments": ["provider rejected structured-output call arguments", "invalid arguments passed to the model"],
    "provider_timeout": ["connection timed out", "litellm.timeout", "timeout passed="],
    "provider_rate_limited": ["key limit exceeded", "rate limit", "429"],
    "length_truncated": ["max_tokens length limit", "finish_reason='length'"],
    "multiple_tool_calls": ["multiple tool calls"],
    "unnamed_entity_filler": ["entity fillers require entity_id or name"],
    "empty_roles": ["candidate roles must not be empty"],
    "bad_evidence_span": ["evidence span"],
    "schema_validation_error": ["validation error for textextractionresponse", "pydantic.dev"],
}


def failure_bucket(error: Column, reasoning: Column) -> Column:
    """Bucket of a trial's failure; an error without a known mark is another failure, and
    neither error nor reasoning is none (null)."""
    first, second = F.lower(F.trim(F.coalesce(error, F.lit("")))), F.lower(F.trim(F.coalesce(reasoning, F.lit(""))))
    both = F.concat(first, F.lit("\n"), second)
    out = F.when((first == "") & (second == ""), F.lit(None).cast("string"))
    for bucket, marks in FAILURES.items():
        holds = F.exists(F.array(*map(F.lit, marks)), lambda m: F.contains(both, m))
        out = out.when(holds & F.contains(both, F.lit("did not resolve")) if bucket == "bad_evidence_span" else holds, bucket)
    return out.otherwise(F.when(first != "", "other_failure"))


def micro(cases: DataFrame, empty: float = 0.0, by: Sequence[str] = ()) -> DataFrame:
    """Sums of (matched, expected, observed) over cases, or over those of each group, with
    precision, recall and F1, rounded to four places."""
    sums = cases.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("matched", "expected", "observed")])
    p, r, f = precision_recall(F.col("matched"), F.col("expected"), F.col("observed"), empty)
    return sums.select(*by, "matched", "expected", "observed", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(f, 4).alias("f1"))


def fidelity(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rates of picked types against wanted ones, for each group: (picked, wanted,
    relation, depth_picked, depth_wanted, error). Errors are counted and left out of all
    rates; ``relation`` is coarser, finer or other."""
    exact = F.col("picked") == F.col("wanted")
    score = ancestor_score(F.col("picked"), F.col("wanted"), F.col("depth_picked"), F.col("depth_wanted"), F.col("relation"))
    fine = F.col("error").isNull()
    rate = lambda c: F.round(F.avg(F.when(fine, c.cast("double"))), 4)
    return rows.groupBy(*by).agg(
        F.count_if(fine).cast("long").alias("n"),
        F.count_if(~fine).cast("long").alias("errors"),
        rate(exact).alias("exact_rate"),
        rate(~exact & (F.col("relation") == "coarser")).alias("ancestor_rate"),
        rate(~exact & (F.col("relation") == "other")).alias("wrong_branch_rate"),
        F.round(F.avg(F.when(fine, score)), 4).alias("mean_score"),
    )


def cluster_answers(questions: DataFrame, clusters: DataFrame, truth: DataFrame) -> DataFrame:
    """Questions (question_id, mention, gold) with ``status``: the mention's clusters
    (mention, cluster) are looked up and their ground truth (cluster, gold_id) compared.
    No cluster: unanswered; several: ambiguous; one whose truths are the gold alone:
    right; else wrong."""
    found = clusters.select("mention", "cluster").distinct().groupBy("mention").agg(F.count("*").alias("n"), F.min("cluster").alias("cluster"))
    ids = truth.groupBy("cluster").agg(F.min("gold_id").alias("low"), F.max("gold_id").alias("high"))
    out = questions.join(found, "mention", "left").join(ids, "cluster", "left")
    right = F.col("low").eqNullSafe(F.col("gold")) & F.col("high").eqNullSafe(F.col("gold"))
    return out.select("question_id", "mention", F.when(F.col("n").isNull(), "unanswered").when(F.col("n") > 1, "ambiguous").when(right, "right").otherwise("wrong").alias("status"))


def evaluator(edges: DataFrame, base: float = 0.8) -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``score`` to rows (picked, wanted, ..) of types, by their places
    in a hierarchy of ``edges`` (child, parent): see ``ancestor_score``. A type that is not
    in the hierarchy has depth 0 and no relatives; a null pick scores 0."""
    from factweave.operators.graph import closure
    from factweave.storage import cut

    above = cut(closure(edges))
    depth = above.groupBy("child").agg(F.max("depth").alias("d"))

    def score(rows: DataFrame) -> DataFrame:
        up = above.select(F.col("child").alias("wanted"), F.col("ancestor").alias("picked"), F.lit("coarser").alias("up"))
        down = above.select(F.col("child").alias("picked"), F.col("ancestor").alias("wanted"), F.lit("finer").alias("down"))
        told = rows.join(up, ["wanted", "picked"], "left").join(down, ["wanted", "picked"], "left")
        told = told.join(depth.select(F.col("child").alias("picked"), F.col("d").alias("dp")), "picked", "left").join(depth.select(F.col("child").alias("wanted"), F.col("d").alias("dw")), "wanted", "left")
        relation = F.coalesce("up", "down", F.lit("other"))
        found = ancestor_score(F.col("picked"), F.col("wanted"), F.coalesce("dp", F.lit(0)), F.coalesce("dw", F.lit(0)), relation, base)
        return told.withColumn("score", F.coalesce(found, F.lit(0.0))).select(*rows.columns, "score")

    return score


def metrics(parts: dict[str, DataFrame]) -> DataFrame:
    """(metric, value) of one-row aggregates of one column each; a null is 0."""
    out = None
    for name, part in parts.items():
        row = part.select(F.lit(name).alias("metric"), F.coalesce(F.col(part.columns[0]).cast("double"), F.lit(0.0)).alias("value"))
        out = row if out is None else out.union(row)
    return out
