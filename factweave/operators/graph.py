"""Recursive and iterative graph operators over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.storage import cut, drop, write


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of each vertex of ``edges`` (u, v): component is the least id that
    can be reached. Alternates large-star and small-star until nothing changes."""
    both = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, state = cut(both), None
    for _ in range(most_rounds):
        sym = now.union(now.select("v", "u"))
        least = cut(sym.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
        large = cut(sym.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(down, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")).select("e.u", F.col("e.m").alias("v"))
        now = cut(small.where("u > v").distinct())
        drop(least, large, down)
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == state or not new[0]:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select("v", "v").distinct())


def closure(edges: DataFrame) -> DataFrame:
    """(child, ancestor, depth) of every ancestor, depth being the least number of edges.
    Safe on cycles and on several parents."""
    spark = edges.sparkSession
    step = cut(edges.select("child", "parent").where("child <> parent").distinct())
    first = step.select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    paths, depth = [write(first)], 1
    front = spark.read.schema(first.schema).parquet(paths[0])
    while True:
        depth += 1
        found = spark.read.schema(first.schema).parquet(*paths)
        up = front.join(step.select(F.col("child").alias("ancestor"), F.col("parent").alias("up")), "ancestor").select("child", F.col("up").alias("ancestor")).where("child <> ancestor").distinct()
        # Each round writes its front alone; what is known is all of them read as one table.
        paths.append(write(up.join(found, ["child", "ancestor"], "left_anti").withColumn("depth", F.lit(depth))))
        front = spark.read.schema(first.schema).parquet(paths[-1])
        if front.isEmpty():
            drop(step)
            return found


def ancestors(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges (parent, child) on any path up from ``roots`` (id), each once."""
    spark = edges.sparkSession
    pairs = cut(edges.select("parent", "child").distinct())
    front = roots.select("id").distinct()
    seen, found, kind = [write(front)], [], front.schema
    while True:
        # No edge is found twice: each child stands in one front alone.
        found.append(write(pairs.join(front.withColumnRenamed("id", "child"), "child", "left_semi").select("parent", "child")))
        up = spark.read.schema(pairs.schema).parquet(found[-1])
        known = spark.read.schema(kind).parquet(*seen)
        seen.append(write(up.select(F.col("parent").alias("id")).distinct().join(known, "id", "left_anti")))
        front = spark.read.schema(kind).parquet(seen[-1])
        if front.isEmpty():
            drop(known)
            return spark.read.schema(pairs.schema).parquet(*found)


def ego(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """(id, hop) of everything within ``hops`` undirected edges of ``seeds`` (id)."""
    both = edges.select("u", "v").union(edges.select("v", "u")).distinct()
    found = cut(seeds.select("id").distinct().withColumn("hop", F.lit(0)))
    front = found
    for hop in range(1, hops + 1):
        near = front.join(both, F.col("id") == F.col("u")).select(F.col("v").alias("id")).distinct()
        front = cut(near.join(found, "id", "left_anti").withColumn("hop", F.lit(hop)))
        found = found.union(front)
    return found


def page_rank(edges: DataFrame, seeds: DataFrame, alpha: float = 0.85, most_rounds: int = 100, tolerance: float = 1e-6) -> DataFrame:
    """(id, rank, settled) by personalised power iteration over undirected edges (u, v)
    with equal start weights of ``seeds`` (id); mass without an edge returns to the
    seeds. ``settled`` says whether the change fell below the tolerance within the
    rounds. Without seeds every vertex starts alike."""
    both = cut(edges.select("u", "v").where("u <> v").union(edges.select("v", "u").where("u <> v")).distinct())
    out = both.groupBy("u").agg(F.count("*").alias("degree"))
    links = cut(both.join(out, "u").select("u", "v", (F.lit(1.0) / F.col("degree")).alias("share")))
    names = links.select(F.col("u").alias("id")).union(seeds.select("id")).distinct()
    start = cut(seeds.select("id").distinct())
    n_seeds, n = start.count(), names.count()
    if not n_seeds:
        start, n_seeds = names, n
    base = cut(names.join(start.withColumn("p", F.lit(1.0 / n_seeds)), "id", "left").select("id", F.coalesce("p", F.lit(0.0)).alias("p")))
    rank, settled = base.select("id", F.col("p").alias("rank")), not n
    for i in range(most_rounds):
        moved = links.join(rank, F.col("u") == F.col("id")).groupBy(F.col("v").alias("id")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        joined = base.join(moved, "id", "left").join(rank.select("id", F.col("rank").alias("old")), "id")
        lost = joined.agg(F.lit(1.0) - F.sum(F.coalesce("got", F.lit(0.0)))).first()[0]
        new = cut(joined.select("id", (alpha * (F.coalesce("got", F.lit(0.0)) + lost * F.col("p")) + (1 - alpha) * F.col("p")).alias("rank"), "old"))
        change = new.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
        rank, settled = new.select("id", "rank"), change is None or change < n * tolerance
        if settled:
            break
    return rank.withColumn("settled", F.lit(settled))


def lineage_sql(spark: SparkSession, edges: DataFrame, root: str, levels: int = 100) -> DataFrame:
    """Ancestor edges of one artifact by a recursive common table expression; for acyclic
    edges only."""
    edges.createOrReplaceTempView("factweave_edges")
    return spark.sql(
        f"""WITH RECURSIVE up MAX RECURSION LEVEL {levels} AS (
            SELECT parent, child FROM factweave_edges WHERE child = '{root}'
            UNION ALL SELECT e.parent, e.child FROM factweave_edges e JOIN up ON e.child = up.parent)
        SELECT DISTINCT parent, child FROM up"""
    )


def traces(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """(seed, id, hop, path, edges): a shortest way from each seed (id) to all that is within
    ``hops`` undirected edges, and the records of the edges it takes.

    ``edges`` has (u, v, seq, record). Of several records of one direction the last by
    ``seq`` counts (ties: the greater record), and a way from x to y takes the record of
    (x, y), or where there is none that of (y, x). Of several shortest ways the one whose
    ids sort first is kept, as its predecessor's is: a round joins what the last one found
    with the edges, and an id keeps its least way by an aggregate.
    """
    last = edges.where("u <> v").groupBy("u", "v").agg(F.max(F.struct("seq", "record")).alias("r")).select("u", "v", F.col("r.record").alias("record"))
    back = last.select(F.col("v").alias("u"), F.col("u").alias("v"), "record")
    ways = cut(last.withColumn("own", F.lit(0)).union(back.withColumn("own", F.lit(1))).groupBy("u", "v").agg(F.min_by("record", "own").alias("record")))
    kind = ways.schema["record"].dataType.simpleString()
    start = seeds.select(F.col("id").alias("seed"), "id").where("id is not null").distinct()
    front = cut(start.select("seed", "id", F.lit(0).alias("hop"), F.array("id").alias("path"), F.array().cast(f"array<{kind}>").alias("edges")))
    found = front
    for hop in range(1, hops + 1):
        step = front.join(ways, F.col("id") == F.col("u")).select("seed", F.col("v").alias("id"), F.array_append("path", F.col("v")).alias("path"), F.array_append("edges", F.col("record")).alias("edges"))
        least = step.groupBy("seed", "id").agg(F.min("path").alias("path"), F.min_by("edges", "path").alias("edges"))
        front = cut(least.join(found.select("seed", "id"), ["seed", "id"], "left_anti").select("seed", "id", F.lit(hop).alias("hop"), "path", "edges"))
        found = found.union(front)
    return found


def pointed(pointers: DataFrame) -> DataFrame:
    """(id, end) where following ``pointers`` (id, target) ends: at an id that points at
    nothing, or that has no row. Paths are halved every round, so one of n steps takes
    log2(n) rounds; a cycle raises."""
    now = cut(pointers.select("id", F.col("target").alias("end")).where("id is not null and end is not null"))
    seen = None
    while True:
        on = now.select(F.col("id").alias("end"), F.col("end").alias("next"))
        step = cut(now.join(on, "end", "left").select("id", F.coalesce("next", "end").alias("end"), F.col("next").isNotNull().alias("moved"), (F.col("id") == F.coalesce("next", "end")).alias("round")))
        left = step.agg(F.count_if("moved"), F.count_if("round")).first()
        if left[1] or (left[0] and left[0] == seen):
            raise ValueError("pointers form a cycle")
        drop(now)
        now, seen = step.select("id", "end"), left[0]
        if not left[0]:
            return now
