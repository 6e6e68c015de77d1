"""Substring search over an index that is stored.

The names, external ids and labels of an identity are cut into grams of one to three
characters; a table of postings, partitioned by a hash of the gram, holds for each gram the
values it stands in. A search reads the partition of one gram of the needle, its rarest,
and verifies what it finds there, so it never scans the entities.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factweave.functions.text import fold
from factweave.operators.search import RANKS

#: Partitions of the postings.
BUCKETS = 64
#: Fields of a value: names of the canonical member, of the others, external ids, labels.
FIELDS = ("canonical", "alias", "external", "label")
_LONGEST = 3


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    path: str
    _read: dict[str, DataFrame] = field(default_factory=dict, compare=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.path}/{name}")
        return self._read[name]


def _grams(value: Column) -> Column:
    def of(size: int) -> Column:
        return F.when(F.length(value) >= size, F.transform(F.sequence(F.lit(1), F.length(value) - (size - 1)), lambda i: F.substring(value, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(n) for n in range(1, _LONGEST + 1)]))


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def build(values: DataFrame, members: DataFrame, path: str, buckets: int = BUCKETS) -> Index:
    """Write the index of ``values`` (owner, field, value, entity_id) and ``members`` (owner,
    entity_id, label, canonical).

    An owner is an identity, or an entity without one; ``entity_id`` is the member whose own
    name a value is, null for what is outside. Null and empty values are left out, repeated
    ones count once. Postings of a gram that very many values hold are spread over files of
    their partition, a value's rows by its hash."""
    spark = values.sparkSession
    told = values.where(F.col("field").isin(*FIELDS) & (F.coalesce(F.col("value"), F.lit("")) != "")).select("owner", "field", fold(F.col("value")).alias("value"), "entity_id").distinct()
    postings = told.withColumn("gram", F.explode(_grams(F.col("value")))).withColumn("bucket", _bucket(F.col("gram"), buckets))
    postings.repartition("bucket", F.pmod(F.xxhash64("value"), F.lit(16))).sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    index = Index(spark, path)
    counts = index.table("postings").groupBy("bucket", "gram").agg(F.count("*").alias("n"))
    counts.repartition("bucket").sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/counts")
    own = members.select("owner", "entity_id", fold(F.coalesce("label", F.lit(""))).alias("label"), "canonical").distinct()
    own.withColumn("bucket", _bucket(F.col("owner"), buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/members")
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")
    return index


def rank(needle: str, kind: Column, value: Column) -> Column:
    """Rank of a match of a folded needle in a value; null if it does not stand in it."""
    name = kind.isin("canonical", "alias")
    exact = F.when(kind == "canonical", RANKS["canonical_exact"]).when(kind == "alias", RANKS["alias_exact"]).when(kind == "external", RANKS["external_id_exact"]).otherwise(RANKS["reference_label_exact"])
    return F.when(value == needle, exact).when(value.startswith(needle), F.when(name, RANKS["prefix"]).otherwise(RANKS["external_prefix"])).when(value.contains(needle), F.when(name, RANKS["substring"]).otherwise(RANKS["external_substring"]))


def hits(index: Index, needle: str, buckets: int) -> DataFrame:
    """(owner, entity_id, rank, exact) of the values that hold a needle, from one gram's
    postings alone."""
    size = min(_LONGEST, len(needle))
    grams = sorted({needle[i : i + size] for i in range(len(needle) - size + 1)})
    homes = dict(zip(grams, index.spark.range(1).select(*[_bucket(F.lit(g), buckets) for g in grams]).first(), strict=True))
    known = index.table("counts").where(F.col("bucket").isin(*set(homes.values())) & F.col("gram").isin(*grams))
    # As many rows as the needle has grams.
    counted = {r["gram"]: r["n"] for r in known.collect()}
    rarest = min(grams, key=lambda g: (counted.get(g, 0), g))
    postings = index.table("postings").where((F.col("bucket") == homes[rarest]) & (F.col("gram") == rarest))
    found = postings.withColumn("rank", rank(needle, F.col("field"), F.col("value"))).where("rank is not null")
    return found.select("owner", "entity_id", "rank", (F.col("value") == needle).alias("exact"))


def search(index: Index, needle: str, limit: int = 20) -> DataFrame:
    """(owner, entity_id, rank, place) of the first ``limit`` members whose identity has a
    value with the needle.

    In order: the best rank of the identity's values, members whose own name is the needle,
    canonical members, label, id. Case and outer blanks of the needle do not count; an
    empty one raises, and so does a limit outside 1 to 200."""
    folded = index.spark.range(1).select(fold(F.lit(needle.strip()))).first()[0]
    if not folded:
        raise ValueError("a search needs a text")
    if not 1 <= limit <= 200:
        raise ValueError("limit must be 1 to 200")
    buckets = index.table("shape").first()["buckets"]
    found = hits(index, folded, buckets)
    best = found.groupBy("owner").agg(F.min("rank").alias("rank")).withColumn("bucket", _bucket(F.col("owner"), buckets))
    own = found.where("exact and entity_id is not null").select("entity_id", F.lit(0).alias("own")).distinct()
    rows = index.table("members").join(best, ["bucket", "owner"]).join(own, "entity_id", "left")
    order = [F.col("rank"), F.coalesce("own", F.lit(1)), F.when(F.col("canonical"), 0).otherwise(1), F.col("label"), F.col("entity_id")]
    first = rows.withColumn("order", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).orderBy("order").limit(limit)
    # The window takes the limited rows alone.
    return first.select("owner", "entity_id", "rank", F.row_number().over(Window.orderBy("order")).cast("long").alias("place"))


def scanned(values: DataFrame, members: DataFrame, needle: str) -> DataFrame:
    """(owner, entity_id, rank) of all members that match, by a scan: what the index must
    give too."""
    told = values.where(F.col("field").isin(*FIELDS) & (F.coalesce(F.col("value"), F.lit("")) != ""))
    best = told.groupBy("owner").agg(F.min(rank(needle, F.col("field"), fold(F.col("value")))).alias("rank")).where("rank is not null")
    return members.join(best, "owner").select("owner", "entity_id", "rank")
