"""Exact similarity join of names by longest common subsequence.

The likeness of two names is 200 * LCS / (length + length) over their words in sorted
order. A likeness of t leaves a known number of insertions and deletions, and each of those
changes a known number of q-grams, so alike names share at least a known number of q-grams.
Ordered from rare to frequent, the first few q-grams of either name then have one in common:
an inverted index over those prefixes meets every pair that can reach the threshold, and
vectorised bit-parallel code scores what meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions import lcs
from factweave.functions.text import sorted_words
from factweave.operators.graph import components
from factweave.storage import cut


def scored(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` with ``score``, the likeness (0 to 100) of two texts as they stand; two
    empty ones are alike. A null counts as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(lcs.ratios(batch.column("_a"), batch.column("_b")))], ["_row", "score"])

    rest = [c for c in pairs.columns if c != "score"]
    rows = pairs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), F.coalesce(F.col(a), F.lit("")).alias("_a"), F.coalesce(F.col(b), F.lit("")).alias("_b"))
    return rows.mapInArrow(work, f"_row {rows.schema['_row'].dataType.simpleString()}, score double").select("_row.*", "score")


def _grams(size: int) -> Column:
    """(gram, k): q-grams of ``sorted``, each with its number among equal ones."""
    grams = F.transform(F.sequence(F.lit(1), F.length("sorted") - (size - 1)), lambda i: F.col("sorted").substr(i, F.lit(size)))
    grams = F.when(F.length("sorted") >= size, grams).otherwise(F.array().cast("array<string>"))
    # Of equal grams the k-th stands behind k - 1 others.
    return F.transform(F.array_sort(grams), lambda g, i: F.struct(g.alias("gram"), (i - F.array_position(F.array_sort(grams), g)).alias("k")))


def _indexed(names: DataFrame, size: int, threshold: float, least: float) -> DataFrame:
    """(family, name, sorted, n, gram, k) of each name's prefix of rarest q-grams.

    With s characters in both names and a common subsequence of L = t s / 200 or more, what
    is deleted and inserted leaves (2q - 1) L - (q - 1) (s + 1) common q-grams at least;
    ``least`` is the smallest s of the pairs that are looked for."""
    n = F.length("sorted")
    smallest = F.greatest(n * F.lit(200.0 / (200.0 - threshold)), F.lit(least))  # a partner has n t / (200 - t) characters or more
    shared = F.greatest(F.lit(1), F.ceil(smallest * ((2 * size - 1) * threshold / 200.0 - (size - 1)) - (size - 1) - 1e-9))
    grams = names.select("family", "name", "sorted", n.alias("n"), (n - (size - 1) - shared + 1).cast("int").alias("prefix"), F.explode(_grams(size)).alias("g")).where("prefix > 0").select("family", "name", "sorted", "n", "prefix", "g.gram", "g.k")
    counts = grams.groupBy("family", "gram").agg(F.count("*").alias("c"))
    ordered = F.array_sort(F.collect_list(F.struct("c", "gram", "k")))
    own = grams.join(counts, ["family", "gram"]).groupBy("family", "name", "sorted", "n", "prefix").agg(ordered.alias("grams"))
    return own.select("family", "name", "sorted", "n", F.explode(F.slice("grams", F.lit(1), F.col("prefix"))).alias("g")).select("family", "name", "sorted", "n", F.concat_ws(":", F.lit(size), "g.k", "g.gram").alias("key"))


def _tables(names: DataFrame, threshold: float) -> tuple[DataFrame, list[tuple[DataFrame, float, float | None]]]:
    """Distinct (name, family) with ``sorted``, and for each size of q-grams the index with
    the bounds of both names' characters, [least, most), within which it tells pairs apart."""
    if not 0 < threshold <= 100:
        raise ValueError("the threshold lies above 0 and at 100 at most")
    named = cut(names.select("name", "family").distinct().where("name is not null").withColumn("sorted", sorted_words(F.col("name"))))
    keyed = []
    below = None
    for size in (3, 2, 1):
        # From this many characters of both names on, q-grams of the size tell pairs apart.
        slope = (2 * size - 1) * threshold / 200.0 - (size - 1)
        if size > 1 and slope <= 0:
            continue
        least = 1.0 if size == 1 else size / slope
        keyed.append((_indexed(named, size, threshold, least), least, below))
        below = least
    return named, keyed


def _near(threshold: float, least: float | Column, most: float | Column | None) -> Column:
    """Whether the lengths of two names lie within the bounds and allow the threshold."""
    total = F.col("n_a") + F.col("n_b")
    near = (total >= F.lit(least) - 1e-9) & (F.least("n_a", "n_b") * 200.0 >= threshold * total - 1e-6)
    return near if most is None else near & (total < F.lit(most) - 1e-9)


def _blank(named: DataFrame) -> DataFrame:
    """Names without a word are alike, and like nothing else."""
    empty = named.where("sorted = ''").select("family", F.col("name").alias("a"))
    least_empty = empty.groupBy("family").agg(F.min("a").alias("first"))
    return empty.join(least_empty, "family").where("a <> first").select("family", F.col("first").alias("a"), F.col("a").alias("b"), F.lit("").alias("sorted_a"), F.lit("").alias("sorted_b"))


def candidates(names: DataFrame, threshold: float) -> DataFrame:
    """(family, a, b, sorted_a, sorted_b) of pairs of distinct (name, family) that may reach
    the threshold; a is the lesser name. None that does is left out."""
    named, keyed = _tables(names, threshold)
    out = None
    for rows, least, most in keyed:
        left = rows.select("family", F.col("name").alias("a"), F.col("sorted").alias("sorted_a"), F.col("n").alias("n_a"), "key")
        right = rows.select("family", F.col("name").alias("b"), F.col("sorted").alias("sorted_b"), F.col("n").alias("n_b"), "key")
        near = (F.col("a") < F.col("b")) & _near(threshold, least, most)
        found = left.join(right, ["family", "key"]).where(near).select("family", "a", "b", "sorted_a", "sorted_b")
        out = found if out is None else out.union(found)
    return out.distinct().union(_blank(named))


def kin(names: DataFrame, threshold: float) -> DataFrame:
    """(family, name, component) of the names (name, family) that others are alike to, directly
    or through others: the least name that alike names lead to. The same as the components
    of ``similar_names``, without all of its pairs.

    First each name of a bucket of the index is compared with the next one in order alone,
    which joins what is alike throughout. A bucket that is one component then has nothing
    more to tell; in the others what is outside the largest component is compared with all that is
    of another one. Where buckets stay apart in many components, that is all their pairs.
    """
    named, keyed = _tables(names.where("family is not null"), threshold)
    index = None
    for rows, least, most in keyed:
        own = rows.withColumns({"least": F.lit(least), "most": F.lit(float("inf") if most is None else most)})
        index = own if index is None else index.union(own)
    index = cut(index)
    told = "family", "a", "b", "sorted_a", "sorted_b"
    near = _near(threshold, F.col("least"), F.col("most"))

    def alike(pairs: DataFrame) -> DataFrame:
        ordered = F.col("a") < F.col("b")
        sides = [F.when(ordered, F.col(f"{c}{x}")).otherwise(F.col(f"{c}{y}")).alias(f"{c}{x}") for c in ("", "sorted_") for x, y in ("ab", "ba")]
        met = pairs.where(near).select("family", *sides).select(*told).distinct()
        return cut(scored(met, "sorted_a", "sorted_b").where(F.col("score") >= threshold).select("family", "a", "b"))

    def joined(links: DataFrame) -> DataFrame:
        node = lambda c: F.struct("family", F.col(c).alias("name"))
        found = components(links.select(node("a").alias("u"), node("b").alias("v")))
        return cut(found.select("id.family", "id.name", F.col("component.name").alias("component")))

    bucket = Window.partitionBy("family", "key").orderBy("sorted", "name")
    following = [F.lead(c).over(bucket).alias(b) for c, b in (("name", "b"), ("sorted", "sorted_b"), ("n", "n_b"))]
    chain = index.select("family", "least", "most", F.col("name").alias("a"), F.col("sorted").alias("sorted_a"), F.col("n").alias("n_a"), *following)
    links = alike(chain.where("b is not null")).union(_blank(named).select("family", "a", "b"))
    first = joined(links)
    rows = index.join(first, ["family", "name"], "left").withColumn("c", F.coalesce("component", "name")).drop("component")
    sizes = rows.groupBy("family", "key", "c").agg(F.count("*").alias("size"))
    tops = sizes.groupBy("family", "key").agg(F.max_by("c", F.struct("size", "c")).alias("top"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    apart = cut(rows.join(tops, ["family", "key"]))
    if apart.isEmpty():
        return first
    left = apart.where("c <> top").select("family", "key", "least", "most", F.col("name").alias("a"), F.col("sorted").alias("sorted_a"), F.col("n").alias("n_a"), F.col("c").alias("c_a"))
    right = apart.select("family", "key", F.col("name").alias("b"), F.col("sorted").alias("sorted_b"), F.col("n").alias("n_b"), F.col("c").alias("c_b"), (F.col("c") == F.col("top")).alias("main"))
    # Of two outside the largest component each pair is met from one side.
    across = alike(left.join(right, ["family", "key"]).where("c_a <> c_b and (main or a < b)"))
    if across.isEmpty():
        return first
    # Components stand in for their names, so that what they lead to is joined once more in small.
    for c in ("a", "b"):
        across = across.join(first.withColumnRenamed("name", c), ["family", c], "left").withColumn(c, F.coalesce("component", c)).drop("component")
    over = joined(across)
    moved = first.join(over.select("family", F.col("name").alias("component"), F.col("component").alias("to")), ["family", "component"], "left")
    alone = over.join(first.select("family", "name"), ["family", "name"], "left_anti")
    return moved.select("family", "name", F.coalesce("to", "component").alias("component")).unionByName(alone)


def similar_names(names: DataFrame, threshold: float = 85.0) -> DataFrame:
    """(family, a, b, score) of names of one family whose likeness reaches the threshold.

    ``names`` has (name, family); repeated rows count once, null names are left out, and a
    null family meets nothing. Names without a word are given as links to the least of them.
    From about 67 on bigrams, from 80 on trigrams carry the index, so what meets stays near
    what is alike; below that only single letters do, and much meets.
    """
    return scored(candidates(names, threshold), "sorted_a", "sorted_b").where(F.col("score") >= threshold).select("family", "a", "b", "score")
