"""Connected components of an edge table, by alternating large-star and small-star; a
small table is joined up in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from factweave.llm._store import forget, written

#: Edges that one task joins up at most (some 100 bytes each there).
SMALL = 300_000


def _stars(both: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours. Written, so that a join on a vertex
    of very many edges has a shuffle on either side, which Spark can split."""
    return written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _canonical(edges: DataFrame) -> DataFrame:
    """Each edge once, the greater end first. ``edges`` is read a single time: which
    spanning links a task gives, and which way round, may differ between two readings."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _in_one_task(edges: DataFrame) -> DataFrame:
    kind = edges.schema["u"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}

        def find(x: object) -> object:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                root.setdefault(u, u)
                root.setdefault(v, v)
                a, b = find(u), find(v)
                if a != b:
                    root[max(a, b)] = min(a, b)
        ids = list(root)
        yield pa.RecordBatch.from_arrays([pa.array(ids, schema), pa.array([find(i) for i in ids], schema)], ["id", "component"])

    schema = to_arrow_type(edges.schema["u"].dataType)
    return edges.select("u", "v").coalesce(1).mapInArrow(work, f"id {kind}, component {kind}")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of each vertex of ``edges`` (u, v); component is the least id
    reachable. Self-loops, repeated and reversed edges are allowed; rows with a null
    end are ignored; no edges give no rows."""
    now = written(_canonical(edges))
    if now.count() <= SMALL:
        return _in_one_task(now)
    made, state = [now], _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = now.union(now.select("v", "u"))
        least = _stars(both)
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = _stars(large)
        joined = large.join(down, "u")
        small = written(joined.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")).select("e.u", F.col("e.m").alias("v")).where("u > v").distinct())
        for table in (least, large, down):
            forget(table)
        made.append(small)
        now, before, state = small, state, _state(small)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    for table in made[:-1]:
        forget(table)
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
