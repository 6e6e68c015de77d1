"""Removal of repeated runs of lines, by a suffix array over line-ID sequences.

DataFrame operations only. A document is its sequence of non-blank lines; equal lines
(by two hashes, white space at either end ignored) share an ID. Lines that occur once in
the corpus end every repeat, so only maximal stretches of repeated lines stay. Their
suffixes are ranked by prefix doubling: the rank after k rounds orders (and names) the
2^k lines that follow a place, a rank being made of the ranks of its two halves; places
whose prefix occurs once drop out. Two overlapping ranks name a run of any length, and
places of one name are an interval of the suffix array whose longest common prefix is at
least that run.

A run counts when it has ``min_words`` words or more. Every such run is the union of
shortest such runs, one from each of its lines forwards and one backwards, so those are
what is looked up: the places of one interval share that run as their common prefix,
and each later one copies the earliest. Copies that go on side by side, place by place,
join into one maximal run; its length is the longest common prefix of the two suffixes
from there on, as far as the earliest copy stays the same. The lines of maximal runs are
removed from the later copy. Doubling stops at the longest of the shortest runs, since
longer prefixes would name the same lines again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factweave.llm._store import forget, written

#: Runs of fewer words are left alone.
MIN_WORDS = 30
#: Documents with removed lines, and ranges of those, that are broadcast at most (some 100
#: and 8 bytes each); beyond that the texts are shuffled to them.
BROADCAST_ROWS, BROADCAST_RANGES = 200_000, 1_000_000


BLANK = " \t\r\x0b\f"


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, copy, i, line, w, h1, h2) of the non-blank lines, i being the place among
    them; ``copy`` tells apart rows that share a key but not a text."""
    bare = F.transform(F.split("text", "\n"), lambda s, k: F.struct(k.alias("line"), F.btrim(s, F.lit(BLANK)).alias("s")))
    exploded = docs.select("doc", "copy", F.posexplode(F.filter(bare, lambda x: x["s"] != "")).alias("i", "x"))
    s = F.col("x.s")
    return exploded.select("doc", "copy", "i", "x.line", F.regexp_count(s, F.lit(r"\S+")).cast("long").alias("w"), F.xxhash64(s).alias("h1"), F.hash(s).alias("h2"))


def _ranked(places: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, rank) of the key tuples that more than one place has. Ranks follow the
    order of the tuples: a range-partitioned sort, numbered partition by partition."""
    many = written(places.groupBy(*keys).agg(F.count("*").alias("c")).where("c > 1").select(*keys))
    return written(many.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keys, F.monotonically_increasing_id().alias("rank")))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text")).where("text is not null and doc is not null").withColumn("copy", F.xxhash64("text"))


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """Maximal runs of lines that copy an earlier place, and the places of all lines that
    may stand in one.

    Runs have (doc, copy, stretch, start, end, first): the lines start to end (both
    included, counted among the non-blank ones) stand at ``first`` (doc, copy, i) and
    after it too, at least ``min_words`` words long. ``copy`` is xxhash64 of the text.
    The earliest place is the one with the least (doc, copy, i). Places have (doc, copy,
    stretch, i, line), line counting all lines."""
    place = ["doc", "copy", "stretch", "i"]
    lines = written(_lines(_rows(docs, key, text)))
    ids = _ranked(lines, ["h1", "h2"])
    # Places of repeated lines; a stretch is a run of them without a gap.
    of_doc = Window.partitionBy("doc", "copy").orderBy("i")
    along = Window.partitionBy("doc", "copy", "stretch").orderBy("i")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stretches = (
        lines.join(ids, ["h1", "h2"])
        .dropDuplicates(["doc", "copy", "i"])
        .withColumn("stretch", F.col("i") - F.row_number().over(of_doc))
        .withColumn("c", F.sum("w").over(along))
        .withColumn("total", F.sum("w").over(whole))
        .where(F.col("total") >= min_words)
        .withColumn("b", F.col("c") - F.col("w"))
    )
    # Lengths in lines of the shortest runs of min_words words from here and up to here.
    span = Window.partitionBy("doc", "copy", "stretch")
    ahead = F.count("*").over(span.orderBy("b").rangeBetween(0, min_words - 1))
    behind = F.count("*").over(span.orderBy("c").rangeBetween(1 - min_words, 0))
    ranks = state = written(
        stretches.withColumn("ahead", ahead).withColumn("behind", behind).select(
            *place, "line", F.when(F.col("total") - F.col("b") >= min_words, F.col("ahead")).alias("ahead"),
            F.when(F.col("c") >= min_words, F.col("behind")).alias("behind"), F.col("rank").alias("r"),
        )
    )
    forget(lines)
    forget(ids)
    longest = state.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 0
    half = 1
    copies = state.select(*place, F.lit(0).cast("long").alias("n"), F.struct("doc", "copy", "i").alias("first")).limit(0)
    while longest >= half:
        # Runs of half to 2 x half - 1 lines: named by the ranks at both ends.
        ahead = ranks.where(F.col("ahead").between(half, 2 * half - 1)).select(*place, F.col("ahead").alias("n"))
        behind = ranks.where(F.col("behind").between(half, 2 * half - 1)).select("doc", "copy", "stretch", (F.col("i") - F.col("behind") + 1).cast("int").alias("i"), F.col("behind").alias("n"))
        ends = ranks.select("doc", "copy", "stretch", F.col("i").alias("end"), F.col("r").alias("right"))
        named = (
            ahead.union(behind).distinct()
            .join(ranks.select(*place, F.col("r").alias("left")), place)
            .withColumn("end", (F.col("i") + F.col("n") - half).cast("int"))
            .join(ends, ["doc", "copy", "stretch", "end"])
        )
        runs = written(named.where("left is not null and right is not null").select(*place, "n", "left", "right"))
        first = written(runs.groupBy("n", "left", "right").agg(F.min(F.struct("doc", "copy", "i")).alias("first"), F.count("*").alias("k")).where("k > 1"))
        later = runs.join(first, ["n", "left", "right"]).where(F.col("first") != F.struct("doc", "copy", "i"))
        copies = copies.union(written(later.select(*place, "n", "first")))
        forget(runs)
        forget(first)
        if longest < 2 * half:
            break
        # Doubling: a place's rank with that of the place half lines on.
        after = ranks.select("doc", "copy", "stretch", (F.col("i") - half).alias("i"), F.col("r").alias("next"))
        pairs = written(ranks.join(after, place, "left"))
        found = _ranked(pairs.where("r is not null and next is not null"), ["r", "next"]).withColumnRenamed("rank", "new")
        grown = written(pairs.join(found, ["r", "next"], "left").select(*place, "line", "ahead", "behind", F.col("new").alias("r")))
        forget(pairs)
        if ranks is not state:
            forget(ranks)
        ranks, half = grown, 2 * half
    # Copies of one source that keep their distance to it and touch are one maximal run.
    shift = F.col("i") - F.col("first.i")
    side = Window.partitionBy("doc", "copy", "stretch", "first.doc", "first.copy", "shift").orderBy("i", "n")
    reach = F.max(F.col("i") + F.col("n")).over(side.rowsBetween(Window.unboundedPreceding, -1))
    begun = copies.withColumn("shift", shift).withColumn("new", F.when(F.col("i") <= reach, 0).otherwise(1))
    runs = (
        begun.withColumn("run", F.sum("new").over(side))
        .groupBy("doc", "copy", "stretch", F.col("first.doc").alias("d"), F.col("first.copy").alias("c"), "shift", "run")
        .agg(F.min("i").alias("start"), F.max(F.col("i") + F.col("n") - 1).cast("int").alias("end"))
    )
    first = F.struct(F.col("d").alias("doc"), F.col("c").alias("copy"), (F.col("start") - F.col("shift")).cast("int").alias("i"))
    return runs.select("doc", "copy", "stretch", "start", "end", first.alias("first")), state.select(*place, "line")


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, copy, i, line) of every line of a run that ``repeated_runs`` gives."""
    runs, places = repeated_runs(docs, key, text, min_words)
    inside = runs.select("doc", "copy", "stretch", F.explode(F.sequence("start", "end")).alias("i")).distinct()
    return inside.join(places, ["doc", "copy", "stretch", "i"]).select("doc", "copy", "i", "line")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs deleted from ``text``, and the added columns
    ``n_lines`` (lines of the text, 0 if null), ``n_removed`` and ``removed`` (ranges of
    line numbers from 0, both ends included; blank lines between removed ones go too).

    The earliest copy of a run stays, by (key, text hash, line), so no text is lost
    altogether. Null and empty texts, and rows with a null key, are returned as they
    are. Rows with equal key and text are one document; both are cut alike. Other
    columns stay, those named like the added ones are replaced.
    """
    lost = repeated_lines(docs, key, text, min_words)
    of_doc = Window.partitionBy("doc", "copy").orderBy("i")
    ranges = (
        lost.withColumn("g", F.col("i") - F.row_number().over(of_doc))
        .groupBy("doc", "copy", "g")
        .agg(F.min("line").alias("first"), F.max("line").alias("last"))
        .groupBy("doc", "copy")
        .agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("__ranges"))
    )
    cut = written(ranges.select(F.col("doc").alias("__doc"), F.col("copy").alias("__copy"), "__ranges"))
    size = cut.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("__ranges")), F.lit(0)).alias("ranges")).first()
    if size["rows"] <= BROADCAST_ROWS and size["ranges"] <= BROADCAST_RANGES:
        cut = F.broadcast(cut)
    rest = [c for c in docs.columns if c not in ("n_lines", "n_removed", "removed")]
    joined = docs.select(*[f"`{c}`" for c in rest]).join(cut, (F.col(key) == F.col("__doc")) & (F.xxhash64(F.col(text).cast("string")) == F.col("__copy")), "left")
    removed = F.coalesce("__ranges", F.array().cast("array<struct<first:int,last:int>>"))
    left = F.filter(F.split(text, "\n"), lambda x, k: ~F.exists("__ranges", lambda r: (r["first"] <= k) & (k <= r["last"])))
    number = F.coalesce(F.size(F.split(text, "\n")), F.lit(0))
    gone = F.aggregate(removed, F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    out = joined.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(number)).withColumn("n_removed", gone).withColumn("removed", removed)
    return out.withColumn(text, F.when(F.col("__ranges").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))).drop("__doc", "__copy", "__ranges")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its removed line ranges and what is left of its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_lines", "n_removed", "removed", "text")
