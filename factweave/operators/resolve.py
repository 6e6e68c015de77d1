"""The model strategy of identity resolution, up to and from the model's answers.

Mentions of a family are ordered so that those a fuzzy pre-filter takes for alike stand
together, cut into batches below a bound of tokens, answered (from a record, the model
stays outside), and what the answers group is checked and joined up by rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.operators import bridges
from factweave.operators.similarity import kin
from factweave.storage import cut

#: Tokens of a request, likeness of the pre-filter, and mentions from which a family is filtered.
TOKENS, LIKENESS, MANY = 50_000, 80.0, 50
#: Characters of a mention's context that a request shows, and of what stands around a mention.
CONTEXT, FRAME = 200, 40


def tokens(entity_id: Column, name: Column, context: Column) -> Column:
    """Estimate of a mention's tokens in a request: a quarter of its characters, upwards."""
    shown = F.length(F.substring(F.coalesce(context, F.lit("")), 1, CONTEXT))
    return F.ceil((F.length(F.coalesce(entity_id, F.lit(""))) + F.length(F.coalesce(name, F.lit(""))) + shown + FRAME) / 4).cast("long")


def running_sums(rows: DataFrame, order: list[str], value: str) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over the rows that come earlier in
    ``order``, which must tell all rows apart. Sums run inside range partitions; what is
    broadcast is one sum for each of those, so no task takes more than a partition."""
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()))
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return own.join(F.broadcast(offsets), "_part").withColumn("before", F.col("_offset") + F.col("_own")).drop("_part", "_place", "_own", "_offset")


def proposals(mentions: DataFrame, likeness: float = LIKENESS, many: int = MANY) -> DataFrame:
    """(family, key, proposal) of the normalised names of families of ``many`` mentions or
    more: names whose likeness reaches the bound, directly or through others, have the
    least of them as their proposal."""
    keyed = mentions.select("family", T.normalize_name(F.col("name")).alias("key"))
    large = keyed.groupBy("family").count().where(F.col("count") >= many).select("family")
    names = cut(keyed.join(large, "family", "left_semi").distinct())
    found = kin(names.select("family", F.col("key").alias("name")), likeness)
    joined = found.select("family", F.col("name").alias("key"), F.col("component").alias("proposal"))
    return names.join(joined, ["family", "key"], "left").select("family", "key", F.coalesce("proposal", "key").alias("proposal"))


def batched(mentions: DataFrame, limit: int = TOKENS, likeness: float = LIKENESS, many: int = MANY) -> DataFrame:
    """``mentions`` (entity_id, name, family, context, ord) with ``proposal``, ``tokens`` and
    ``batch``, the number of the family's request that each is in.

    Every mention is in one batch, and the tokens of a batch stay below ``limit``. Mentions
    of one proposal stand side by side; a proposal larger than a batch goes on in the next.
    A family of a single mention needs no request and has a null batch. A mention of more
    than half the limit raises: requests could not be filled.
    """
    proposed = proposals(mentions, likeness, many)
    sized = mentions.withColumns({"key": T.normalize_name(F.col("name")), "tokens": tokens(F.col("entity_id"), F.col("name"), F.col("context"))})
    placed = cut(sized.join(proposed, ["family", "key"], "left").withColumn("proposal", F.coalesce("proposal", F.lit(""))).drop("key"))
    most = placed.agg(F.max("tokens")).first()[0] or 0
    if 2 * most > limit:
        raise ValueError(f"a mention of {most} tokens is beyond half of the {limit} of a request")
    summed = cut(running_sums(placed, ["family", "proposal", "ord", "entity_id"], "tokens"))
    of_family = summed.groupBy("family").agg(F.min("before").alias("base"), F.count("*").alias("n"))
    # A batch takes what begins inside its stretch, so it ends less than one mention beyond it.
    batch = F.floor((F.col("before") - F.col("base")) / F.lit(limit - most)).cast("long")
    return summed.join(of_family, "family").withColumn("batch", F.when(F.col("n") > 1, batch)).drop("before", "base", "n")


def grouped(batches: DataFrame, answers: DataFrame) -> DataFrame:
    """(entity_id, root) after the recorded ``answers`` (family, batch, position, members).

    A member that is not in the answer's batch is ignored, one in several clusters belongs
    to the first by position, and a mention in none stands alone. Clusters of persons fall
    apart where names forbid one person, and groups that names, signatures and bridges make
    one are joined. ``root`` is the least mention of a group.
    """
    claims = answers.select("family", "batch", "position", F.explode("members").alias("entity_id"))
    first = claims.groupBy("family", "batch", "entity_id").agg(F.min("position").alias("position"))
    own = batches.join(first, ["family", "batch", "entity_id"], "left")
    cluster = F.when(F.col("position").isNotNull(), F.concat_ws("|", "family", "batch", "position")).otherwise(F.concat_ws("|", F.lit("alone"), "entity_id"))
    clustered = cut(own.withColumn("cluster", cluster))
    parts = bridges.split_persons(clustered.select("cluster", "entity_id", "name", "family", "ord"))
    named = clustered.join(parts, ["cluster", "entity_id"])
    least = named.groupBy("cluster", "part").agg(F.min("entity_id").alias("root"))
    mentions = cut(named.join(least, ["cluster", "part"]).select("root", "entity_id", "name", "family", "context"))
    return bridges.collapsed(mentions)
