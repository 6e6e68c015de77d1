"""Identity resolution: strategies, clusters, bridges and their metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.operators.graph import components
from factweave.operators.similarity import similar_names as similar_names


def group_exact(entities: DataFrame) -> DataFrame:
    """(name_key, members, canonical) by normalised name, without regard to type; the
    canonical member is the first by (ord, entity_id)."""
    keyed = entities.withColumn("name_key", T.normalize_name(F.col("name")))
    return keyed.groupBy("name_key").agg(F.count("*").alias("members"), F.min_by("entity_id", F.struct("ord", "entity_id")).alias("canonical"))


def clusters(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every name with the least name of its cluster."""
    found = components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return names.join(found.select(F.col("id").alias("name"), "component"), "name", "left").withColumn("cluster", F.coalesce("component", "name")).drop("component")


def near_duplicates(names: DataFrame) -> DataFrame:
    """Pairs (a, b, method) of distinct names that look alike.

    Tests in order, the first whose premise holds decides: one contains the other (then
    the shorter needs three characters and half the length), one is the other's acronym,
    edit distance of at most one for names of up to 30 characters. Candidates come from
    equi-joins: acronyms, and variants with one character left out; containment joins on
    shared words.
    """
    base = names.select("name", T.comparison_name(F.col("name")).alias("n"), T.acronym(F.col("name")).alias("acr"), "kind").distinct()
    left = base.select(*[F.col(c).alias(f"{c}_a") for c in base.columns])
    right = base.select(*[F.col(c).alias(f"{c}_b") for c in base.columns])
    cuts = F.concat(F.array(F.col("n")), F.transform(F.sequence(F.lit(1), F.length("n")), lambda i: F.concat(F.substr("n", F.lit(1), i - 1), F.substr("n", i + 1))))
    short = base.where((F.length("n") <= 30) & (F.length("n") > 0)).withColumn("key", F.explode(F.array_distinct(cuts))).select("name", "key")
    grams = base.where("length(n) >= 3").withColumn("key", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("n") - 2), lambda i: F.substr("n", i, F.lit(3)))))).select("name", F.concat(F.lit("3:"), "key").alias("key"))
    acr = base.where("acr <> ''").select("name", F.concat(F.lit("a:"), "acr").alias("key")).union(base.select("name", F.concat(F.lit("a:"), F.upper("n")).alias("key")))
    # A name inside another brings all its trigrams there; its rarest one meets the fewest.
    rare = grams.groupBy("key").agg(F.count("*").alias("c"))
    first = grams.join(rare, "key").groupBy("name").agg(F.min_by("key", F.struct("c", "key")).alias("key"))
    near = _meet(short, short).union(_meet(acr, acr)).union(_meet(first, grams)).distinct()
    pairs = near.join(left, F.col("a") == F.col("name_a")).join(right, F.col("b") == F.col("name_b"))
    inside = (F.col("n_a") != "") & (F.col("n_b") != "") & (F.col("n_a").contains(F.col("n_b")) | F.col("n_b").contains(F.col("n_a")))
    lengths = F.least(F.length("n_a"), F.length("n_b")), F.greatest(F.length("n_a"), F.length("n_b"))
    method = (
        F.when(inside, F.when((lengths[0] >= 3) & (lengths[0] >= 0.5 * lengths[1]), "substring"))
        .when((F.col("acr_a") != "") & ((F.col("acr_a") == F.upper("n_b")) | (F.col("acr_a") == F.col("name_b"))), "acronym")
        .when((F.col("acr_b") != "") & ((F.col("acr_b") == F.upper("n_a")) | (F.col("acr_b") == F.col("name_a"))), "acronym")
        .when((lengths[1] <= 30) & (F.levenshtein("n_a", "n_b", 1) >= 0), "edit")
    )
    return pairs.withColumn("method", method).where(F.col("method").isNotNull() & T.types_compatible(F.col("kind_a"), F.col("kind_b"))).select(F.col("name_a").alias("a"), F.col("name_b").alias("b"), "method").distinct()


def _meet(left: DataFrame, right: DataFrame) -> DataFrame:
    both = left.select(F.col("name").alias("x"), "key").join(right.select(F.col("name").alias("y"), "key"), "key").where("x <> y")
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def structural_duplicates(profiles: DataFrame, threshold: float = 0.35, least: int = 2) -> DataFrame:
    """Pairs (a, b, jaccard) of entities whose sets of (predicate, role) are alike.

    ``profiles`` has distinct (entity_id, item); entities with fewer than ``least`` items
    take no part. With its items in order of rarity, a set of n shares one of its first
    n - ceil(threshold n) + 1 with every set as alike as that, so only those are joined;
    pairs are confirmed on whole sets.
    """
    rare = profiles.groupBy("item").agg(F.count("*").alias("c"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("c", "item"))), lambda x: x["item"])
    sets = profiles.join(rare, "item").groupBy("entity_id").agg(ordered.alias("items")).withColumn("n", F.size("items")).where(F.col("n") >= least)
    prefix = F.slice("items", F.lit(1), (F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1).cast("int"))
    keys = sets.select("entity_id", F.explode(prefix).alias("item"))
    met = keys.select(F.col("entity_id").alias("a"), "item").join(keys.select(F.col("entity_id").alias("b"), "item"), "item").where("a < b").select("a", "b").distinct()
    one = lambda side: sets.select(F.col("entity_id").alias(side), F.col("items").alias(f"items_{side}"))
    both = met.join(one("a"), "a").join(one("b"), "b").withColumn("i", F.size(F.array_intersect("items_a", "items_b")))
    jaccard = F.col("i") / (F.size("items_a") + F.size("items_b") - F.col("i"))
    return both.select("a", "b", jaccard.alias("jaccard")).where(F.col("jaccard") >= threshold)


def pairwise_metrics(rows: DataFrame, predicted: str, gold: str) -> DataFrame:
    """Precision, recall and counts of clustered pairs, from contingency sums; an empty
    denominator gives 1."""

    def pairs(*keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("p"))

    both, p, g = pairs(predicted, gold), pairs(predicted), pairs(gold)
    out = both.select(F.col("p").alias("tp")).crossJoin(p.select(F.col("p").alias("pp"))).crossJoin(g.select(F.col("p").alias("gp")))  # one row each
    return out.select(
        F.col("tp").cast("long").alias("true_pairs"),
        (F.col("pp") - F.col("tp")).cast("long").alias("false_merges"),
        (F.col("gp") - F.col("tp")).cast("long").alias("false_splits"),
        F.round(F.when(F.col("pp") == 0, 1.0).otherwise(F.col("tp") / F.col("pp")), 4).alias("pair_precision"),
        F.round(F.when(F.col("gp") == 0, 1.0).otherwise(F.col("tp") / F.col("gp")), 4).alias("pair_recall"),
    )


def unique_bridge(weak: DataFrame, anchors: DataFrame, key: Column) -> DataFrame:
    """Edges (u, v) from weak mentions to the one anchor root that shares their key; a key
    with several roots bridges nothing."""
    roots = anchors.withColumn("k", key).groupBy("k").agg(F.min("root").alias("v"), F.count_distinct("root").alias("n")).where("n = 1")
    return weak.withColumn("k", key).join(roots, "k").select(F.col("root").alias("u"), "v").where("u <> v")


def signature_counts(names: DataFrame) -> DataFrame:
    """(name, n_signatures, others): with how many other names each name (name, signatures: an
    array) shares a signature, without forming pairs.

    By inclusion and exclusion over the sets of its signatures: a name of r signatures gives
    2^r - 1 rows, and a signature that very many names have is one row of counts. Repeated
    signatures count once; a null array has none; names must be distinct."""
    own = names.select("name", F.array_sort(F.array_distinct(F.coalesce("signatures", F.array().cast("array<string>")))).alias("s"))
    empty = F.array(F.array().cast("array<string>"))
    sets = F.filter(F.aggregate("s", empty, lambda done, x: F.concat(done, F.transform(done, lambda d: F.concat(d, F.array(x))))), lambda d: F.size(d) > 0)
    keyed = own.select("name", F.explode(sets).alias("d")).select("name", F.xxhash64("d").alias("h1"), F.hash("d").alias("h2"), F.when(F.size("d") % 2 == 1, 1).otherwise(-1).alias("sign"))
    sizes = keyed.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    shared = keyed.join(sizes, ["h1", "h2"]).groupBy("name").agg(F.sum(F.col("sign") * F.col("n")).alias("with"))
    return own.join(shared, "name", "left").select("name", F.size("s").alias("n_signatures"), F.coalesce(F.col("with") - 1, F.lit(0)).cast("long").alias("others"))
