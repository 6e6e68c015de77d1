"""Intervals of experiments by a bootstrap whose weights are hashed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Replicates of an interval.
REPLICATES = 200


def poisson_weight(replicate: Column, case: Column) -> Column:
    """How often a case is drawn into a replicate: Poisson of mean 1, from the md5 of
    "replicate:case". The same wherever the row lies, so sums of partitions merge."""
    u = F.conv(F.substring(F.md5(F.concat_ws(":", replicate.cast("string"), case.cast("string"))), 1, 8), 16, 10).cast("long")
    out, total = F.lit(0), 0.0
    for k in range(11):
        total += math.exp(-1) / math.factorial(k)
        out = out + (u >= F.lit(int(total * 2**32))).cast("int")
    return out


def intervals(rows: DataFrame, keys: list[str], case: str, value: str, replicates: int = REPLICATES, level: float = 0.95) -> DataFrame:
    """(keys, n, mean, low, high): the mean of ``value`` over cases and the percentile
    interval of its bootstrap replicates.

    One pass over the rows: each adds its weight and weighted value to every replicate,
    combined before the shuffle, which carries a row for each key, replicate and task. Rows
    with a null case or value are left out; all rows of one case are drawn together. A
    replicate that draws nothing is left out; without one the interval is null."""
    told = rows.where(F.col(case).isNotNull() & F.col(value).isNotNull())
    drawn = told.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(replicates)))).withColumn("_w", F.when(F.col("_r") == replicates, 1).otherwise(poisson_weight(F.col("_r"), F.col(case))))
    sums = drawn.groupBy(*keys, "_r").agg(F.sum("_w").alias("w"), F.sum(F.col("_w") * F.col(value)).alias("s"))
    mean = F.col("s") / F.col("w")
    drawn_mean = F.when((F.col("_r") < replicates) & (F.col("w") > 0), mean)
    tail = (1 - level) / 2
    return sums.groupBy(*keys).agg(
        F.max(F.when(F.col("_r") == replicates, F.col("w"))).cast("long").alias("n"),
        F.max(F.when(F.col("_r") == replicates, mean)).alias("mean"),
        F.percentile(drawn_mean, tail).alias("low"),
        F.percentile(drawn_mean, 1 - tail).alias("high"),
    )


def paired(rows: DataFrame, case: str, variant: str, value: str, base: str) -> DataFrame:
    """(case, variant, difference) of each variant's mean value for a case against that of
    ``base``; a case without one of the two is left out."""
    means = rows.where(F.col(value).isNotNull()).groupBy(case, variant).agg(F.avg(value).alias("m"))
    own = means.where(F.col(variant) == base).select(case, F.col("m").alias("base"))
    return means.where(F.col(variant) != base).join(own, case).select(case, variant, (F.col("m") - F.col("base")).alias("difference"))
