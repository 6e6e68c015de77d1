"""Shard placement by a permutation-filled lookup table.

Every shard has its own preference order of the slots of a prime-sized table (an
offset and a stride, both hashed from its name). Shards take turns to claim their
next free slot until the table is full; a heavier shard takes more turns. A row goes
to the shard that owns slot ``hash(key) mod size``. Adding or removing a shard moves
few rows besides that shard's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The table has this many slots at most, so what is broadcast has a fixed bound.
MOST_SLOTS = 1_048_583


def _is_prime(n: int) -> bool:
    if n < 2:
        return False
    d = 2
    while d * d <= n:
        if n % d == 0:
            return False
        d += 1
    return True


def _number(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], size: int = 65_537, weights: Sequence[int] | None = None) -> list[int]:
    """Owner (an index into ``shards``) of each slot.

    ``size`` must be prime and not below the number of shards; equal names, no shards
    and weights below 1 are refused.
    """
    if not _is_prime(size) or not len(shards) <= size <= MOST_SLOTS:
        raise ValueError("size must be a prime between the number of shards and MOST_SLOTS")
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    turns = list(weights) if weights is not None else [1] * len(shards)
    if len(turns) != len(shards) or min(turns) < 1:
        raise ValueError("one weight of at least 1 for each shard")
    at = [_number(s, "offset") % size for s in shards]
    step = [_number(s, "stride") % (size - 1) + 1 if size > 2 else 1 for s in shards]
    owner, filled = [-1] * size, 0
    while filled < size:
        for shard, turn in enumerate(turns):
            for _ in range(turn):
                while owner[at[shard]] >= 0:
                    at[shard] = (at[shard] + step[shard]) % size
                owner[at[shard]] = shard
                filled += 1
                if filled == size:
                    return owner
    return owner


def place(docs: DataFrame, shards: Sequence[str], key: str = "doc_id", size: int = 65_537, weights: Sequence[int] | None = None) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``.

    The slot comes from the first 15 hexadecimal digits of md5 of the key as text, so
    equal keys (also repeated rows) always share a shard; a null key counts as the
    empty text. Columns of ``docs`` named slot or shard are replaced. No shuffle: the
    table of ``size`` rows is broadcast, whatever the number of rows.
    """
    owner = lookup_table(shards, size, weights)
    spark = docs.sparkSession
    names = spark.createDataFrame([(i, shards[o]) for i, o in enumerate(owner)], "slot long, shard string")
    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 15)
    slot = F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size))
    kept = docs.drop(*[c for c in ("slot", "shard") if c in docs.columns and c != key])
    return kept.withColumn("slot", slot).join(F.broadcast(names), "slot").select(*kept.columns, "slot", "shard")


SHARDS = tuple(f"shard-{i:02d}" for i in range(64))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, as doc_id, slot, shard."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return place(docs, SHARDS)


def op10_sql() -> str:
    """The same placement over a literal table."""
    owner = lookup_table(SHARDS)
    rows = ",".join(str(o) for o in owner)
    return f"""
WITH owner AS (SELECT [{rows}] AS o),
slots AS (
  SELECT doc_id, (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {len(owner)}) AS slot
  FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(CAST(o[slot + 1] AS VARCHAR), 2, '0') AS shard FROM slots, owner
"""
