"""Near-duplicate documents by SetSketch registers over word shingles.

A document's set of shingles is summarised by registers: for each, the least of the
elements' exponential variates, on an exponentially spaced scale, rounded down and
truncated. The sketch of a union is the register-wise maximum. Bands of registers put
similar documents into common buckets; candidates are estimated jointly by maximum
likelihood from how many registers are equal, larger or smaller, and the survivors are
confirmed on the full sets.

Equal sets form a class first and enter once; the rows of one key may lie in several
classes, whose components are joined at the end. A bucket is not expanded into pairs:
each member meets the bucket's first, and what is apart after that is compared block by
block inside a task, in the first band that a pair has in common: pairs estimated near or
above the threshold are confirmed there on the full sets unless they are joined by then,
and only links that join something leave a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import _words
from factweave.llm._graph import components
from factweave.llm._store import bounded_batches, forget, written

BASE, RATE, MOST = 1.001, 20.0, 65_534
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
#: A pair is confirmed when its estimate comes within this of the threshold: five
#: standard deviations of the estimate at a similarity of 0.8.
SLACK = 0.13
#: Members of a bucket that one task compares with as many others.
BLOCK = 512
#: Pairs whose registers are compared at once.
PAIRS = 40_000
#: Ids that are broadcast at most (8 bytes each), else the join shuffles.
BROADCAST_IDS = 1_000_000

_FACTORS = np.random.default_rng(7).integers(0, 1 << 32, (2, REGISTERS), dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def registers(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers of each set; ``bounds`` delimits the sets, none of them empty."""
    out = np.empty((len(bounds) - 1, REGISTERS), np.uint32)
    low = (elements >> np.uint64(32)).astype(np.uint32)
    starts = bounds[:-1]
    step = 1 << 18
    cuts = [0]
    while cuts[-1] < len(starts):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(bounds, bounds[cuts[-1]] + step, side="right")) - 1))
    for first, last in zip(cuts, cuts[1:], strict=False):
        own = low[bounds[first] : bounds[last]]
        at = starts[first:last] - bounds[first]
        work = np.empty_like(own)
        for j in range(REGISTERS):
            np.multiply(own, _FACTORS[0, j], out=work)
            np.add(work, _FACTORS[1, j], out=work)
            out[first:last, j] = np.minimum.reduceat(work, at)
    least = -np.log1p(-(out + 0.5) / 2.0**32)
    return np.clip(np.floor(1 - np.log(RATE * least) / np.log(BASE)), 0, MOST + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sets of known sizes, from how many
    registers of the first are larger and smaller than the second's."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    equal = REGISTERS - larger - smaller

    def p(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)

    def likelihood(j: np.ndarray) -> np.ndarray:
        a, b = p(u - v * j), p(v - u * j)
        return larger * np.log(a) + smaller * np.log(b) + equal * np.log(np.clip(1 - a - b, 1e-12, 1))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        a, b = high - (high - low) * 0.618034, low + (high - low) * 0.618034
        left = likelihood(a) >= likelihood(b)
        high, low = np.where(left, b, high), np.where(left, low, a)
    return (low + high) / 2


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for chunk in _words.chunks(batch, "text"):
        data, offsets = _words.raw(chunk.column("text"))
        made, bounds = _words.shingles(*_words.words(data, offsets, _words.SPACES), size)
        yield chunk, [np.unique(made[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(name, key, n, s1, s2, bands, registers) of each row (name, key, text); s1 and s2
    name the set. Empty sets have no bands."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = _words.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            for chunk, sets in _sets(batch, shingle):
                sizes = np.asarray([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                names = np.zeros((2, len(sets)), np.uint64)
                bands = np.zeros((len(full), BANDS), np.uint64)
                regs = np.zeros((len(full), REGISTERS), np.uint16)
                if len(full):
                    every = np.concatenate([sets[i] for i in full])
                    bounds = np.concatenate([[0], np.cumsum(sizes[full])])
                    names[0, full] = np.add.reduceat(every, bounds[:-1])
                    names[1, full] = np.bitwise_xor.reduceat(_words.mix(every + np.uint64(77)), bounds[:-1])
                    regs = registers(every, bounds)
                    for r in range(ROWS):
                        bands = (bands ^ regs[:, r::ROWS]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r + 1)
                    bands = _words.mix(bands ^ salts)
                at = np.concatenate([[0], np.cumsum(sizes > 0)])
                lists = pa.ListArray.from_arrays(pa.array((at * BANDS).astype(np.int32)), pa.array(bands.view(np.int64).ravel()))
                data = pa.Array.from_buffers(pa.binary(), len(sets), [None, pa.py_buffer((at * REGISTERS * 2).astype(np.int32).tobytes()), pa.py_buffer(regs.astype("<u2").tobytes())])
                yield pa.RecordBatch.from_arrays([chunk.column("name"), chunk.column("key"), pa.array(sizes), pa.array(names[0].view(np.int64)), pa.array(names[1].view(np.int64)), lists, data], ["name", "key", "n", "s1", "s2", "bands", "registers"])

    return bounded_batches(docs).mapInArrow(work, f"name {docs.schema['name'].dataType.simpleString()}, key {docs.schema['key'].dataType.simpleString()}, n long, s1 long, s2 long, bands array<long>, registers binary")


def _counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (a > b).sum(-1), (a < b).sum(-1)


def _likely(pairs: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose joint estimate is near or above the threshold."""
    one = sketch.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    two = sketch.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    both = pairs.join(one, "a").join(two, "b").where(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(_bytes(batch.column(c)), "<u2").reshape(-1, REGISTERS) for c in ("r_a", "r_b"))
            near = estimate(*_counts(a, b), batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()) >= threshold - SLACK
            yield batch.select(["a", "b"]).filter(pa.array(near))

    kind = sketch.schema["key"].dataType.simpleString()
    return both.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(work, f"a {kind}, b {kind}")


def _bytes(column: pa.Array) -> np.ndarray:
    return _words.raw(column.cast(pa.large_binary()))[0]


def full_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(key, s): the sorted full set of each document named in ``ids`` (key)."""
    ids = written(ids)
    few = ids.count() <= BROADCAST_IDS
    named = docs.join(F.broadcast(ids) if few else ids, "key", "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, sets in _sets(batch, shingle):
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([chunk.column("key"), pa.ListArray.from_arrays(pa.array(at), pa.array(values.view(np.int64)))], ["key", "s"])

    return written(bounded_batches(named).mapInArrow(work, f"key {docs.schema['key'].dataType.simpleString()}, s array<long>").dropDuplicates(["key"]))


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 x intersection >= percent x union of the full sets."""
    pairs = written(pairs)
    sets = full_sets(docs, pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), shingle)
    shared = F.size(F.array_intersect("s_a", "s_b"))
    out = written(
        pairs.join(sets.select(F.col("key").alias("a"), F.col("s").alias("s_a")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("s").alias("s_b")), "b")
        .select("a", "b", shared.alias("i"), (F.size("s_a") + F.size("s_b")).alias("t"))
        .where(F.lit(100) * F.col("i") >= F.lit(percent) * (F.col("t") - F.col("i")))
        .select("a", "b")
    )
    forget(pairs)
    forget(sets)
    return out


def _pairs(rows: pa.RecordBatch, edges: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one block pair (``edges`` delimits them) but different components
    that have this band first in common and an estimate near or above the threshold."""
    regs = np.frombuffer(_bytes(rows.column("registers")), "<u2").reshape(-1, REGISTERS)
    n = rows.column("n").to_numpy()
    comp = rows.column("component").to_numpy(zero_copy_only=False)
    block, number = rows.column("block").to_numpy(), rows.column("number").to_numpy()
    split = rows.column("i").to_numpy() != rows.column("j").to_numpy()
    # Row x meets the rows after it in its group.
    after = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(n)) - 1
    total = np.concatenate([[0], np.cumsum(after)])
    first = 0
    while first < len(n):
        last = max(first + 1, int(np.searchsorted(total, total[first] + PAIRS, side="right")) - 1)
        times = after[first:last]
        a = np.repeat(np.arange(first, last), times)
        b = a + 1 + np.arange(len(a)) - np.repeat(total[first:last] - total[first], times)
        first = last
        ok = (comp[a] != comp[b]) & (np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b])) & ~(split[a] & (block[a] == block[b]))
        a, b = a[ok], b[ok]
        equal = regs[a] == regs[b]
        ok = equal.sum(1) >= REGISTERS * (threshold - 0.26)
        a, b, equal = a[ok], b[ok], equal[ok]
        ok = equal.reshape(-1, BANDS, ROWS).all(2).argmax(1) == number[a] if len(a) else np.zeros(0, bool)
        a, b = a[ok], b[ok]
        if len(a):
            ok = estimate(*_counts(regs[a], regs[b]), n[a], n[b]) >= threshold - SLACK
            if ok.any():
                yield a[ok], b[ok]


def _grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted rows as runs of whole groups, with the groups' bounds."""
    held: pa.RecordBatch | None = None  # the last group so far, which may go on
    for batch in batches:
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        marks = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in keys])
        edges = np.concatenate([[0], np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1])
        held = rows.slice(int(edges[-1]))
        if len(edges) > 1:
            yield rows.slice(0, int(edges[-1])), edges
    if held is not None:
        yield held, np.asarray([0, held.num_rows])


_UNIT = ("band", "i", "j")


def _cross(members: DataFrame, docs: DataFrame, shingle: int, threshold: float, percent: int) -> DataFrame:
    """Links (a, b) between members of one bucket but different components, enough of them
    to join what all of them join. ``members`` has (band, number, key, component, n,
    registers, c), c being the bucket's size and number that of the band. A block pair has
    2 x BLOCK rows or so."""
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    own = members.withColumn("m", blocks).withColumn("block", F.pmod(F.xxhash64("key"), F.col("m")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j")))
    dealt = own.withColumn("p", F.explode(pair)).select("band", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "number", "block", "key", "component", "n", "registers")
    dealt = dealt.repartition(*_UNIT).sortWithinPartitions(*_UNIT)
    kind = members.schema["key"].dataType.simpleString()
    fields = ["band", "i", "j", "number", "block", "key", "component", "n", "registers"]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in _grouped(batches, _UNIT):
            hit = np.zeros(rows.num_rows, bool)
            for a, b in _pairs(rows, edges, threshold):
                hit[a] = hit[b] = True
            yield rows.select(fields).filter(pa.array(hit))

    rows = written(dealt.mapInArrow(near, f"band long, i int, j int, number int, block int, key {kind}, component {kind}, n long, registers binary"))
    sets = full_sets(docs, rows.select("key").distinct(), shingle)
    full = rows.join(sets, "key").repartition(*_UNIT).sortWithinPartitions(*_UNIT)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in _grouped(batches, _UNIT):
            lists = rows.column("s")
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            comp = rows.column("component").to_pylist()
            group = np.repeat(np.arange(len(edges) - 1), np.diff(edges)).tolist()
            root: dict = {}

            def find(x: tuple) -> tuple:
                root.setdefault(x, x)
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            one, two = [], []
            for a, b in _pairs(rows, edges, threshold):
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    p, q = find((group[x], comp[x])), find((group[y], comp[y]))
                    if p == q:
                        continue
                    u, v = flat[at[x] : at[x + 1]], flat[at[y] : at[y + 1]]
                    both = np.concatenate([u, v])
                    both.sort()
                    shared = int((both[1:] == both[:-1]).sum())
                    if 100 * shared >= percent * (len(both) - shared):
                        root[q] = p
                        one.append(x)
                        two.append(y)
            keys = rows.column("key")
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(one, pa.int64())), keys.take(pa.array(two, pa.int64()))], ["a", "b"])

    return full.select(*fields, "s").mapInArrow(join, f"a {kind}, b {kind}")


def _of_keys(sketch: DataFrame, of_class: DataFrame) -> DataFrame:
    """(name, n, component_id) of each row of ``sketch`` (name, n, s1, s2): parts of
    ``of_class`` (n, s1, s2, part) that share a name are joined, and the least name of what
    hangs together is the component's."""
    member = written(sketch.where("n > 0 and name is not null").join(of_class, ["n", "s1", "s2"]).select("name", "n", "part"))
    several = written(member.groupBy("name").agg(F.min("part").alias("u"), F.max("part").alias("most")).where("u != most").select("name", "u"))
    wider = components(member.join(several, "name").where("part != u").select("u", F.col("part").alias("v")))
    parts = written(
        member.groupBy("part").agg(F.min("name").alias("least"))
        .join(wider.withColumnRenamed("id", "part"), "part", "left")
        .select("part", "least", F.coalesce("component", "part").alias("whole"))
    )
    wholes = written(parts.groupBy("whole").agg(F.min("least").alias("component_id")))
    full = member.join(written(parts.join(wholes, "whole").select("part", "component_id")), "part").select("name", "n", "component_id")
    empty = sketch.where("n = 0 and name is not null").select("name", "n")
    of_empty = written(full.join(empty.select("name").distinct(), "name", "left_semi").groupBy("name").agg(F.min("component_id").alias("found")))
    rest = empty.join(of_empty, "name", "left").select("name", "n", F.coalesce("found", "name").alias("component_id"))
    unnamed = sketch.where("name is null").select("name", "n", F.col("name").alias("component_id"))
    return full.union(rest).union(unnamed)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) of each document.

    Words are what white space (ASCII) separates, A-Z lower-cased; a text of fewer than
    ``shingle`` words is one shingle. Null and empty texts have no shingles and are
    linked with nothing, nor is a row with a null key (its component is null, kept
    false). Rows that share a key are one document: the links of each of their texts count
    for the key, and all of them get its component. Rows are told apart by a hash of key
    and text of 64 bits; two of N distinct ones agree with probability N^2 / 2^65. Further
    columns are not read; an empty table gives no rows. A pair of similarity 0.8 escapes
    all bands with probability 5e-6.
    """
    threshold = percent / 100
    rows = docs.select(F.col(key).alias("name"), F.col(text).cast("string").alias("text")).withColumn("key", F.xxhash64("name", "text"))
    sketch = written(sketches(rows, shingle))
    rows = rows.select("key", "text")
    named = sketch.where("n > 0 and name is not null")
    classes = written(named.groupBy("n", "s1", "s2").agg(F.min("key").alias("rep")))
    reps = written(named.join(classes.select(F.col("rep").alias("key")), "key", "left_semi").dropDuplicates(["key"]).select("key", "n", "bands", "registers"))
    buckets = reps.select("key", F.posexplode("bands").alias("number", "band"))
    hubs = written(buckets.groupBy("band").agg(F.min("key").alias("hub"), F.count("*").alias("c")).where("c > 1"))
    star = buckets.join(hubs, "band").where("key != hub").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
    links = confirmed(_likely(star, reps, threshold), rows, shingle, percent)
    found = written(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    inside = written(
        buckets.join(hubs.select("band", "c"), "band")
        .join(found.withColumnRenamed("id", "key"), "key", "left")
        .select("band", "number", "key", "c", F.coalesce("component", "key").alias("component"))
    )
    apart = inside.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("band")
    members = inside.join(written(apart), "band", "left_semi").join(reps.select("key", "n", "registers"), "key")
    more = _cross(members, rows, shingle, threshold, percent)
    found = written(components(links.union(more).select(F.col("a").alias("u"), F.col("b").alias("v"))))
    forget(inside)
    of_class = written(classes.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("n", "s1", "s2", F.coalesce("component", "rep").alias("part")))
    return _of_keys(sketch.select("name", "n", "s1", "s2"), of_class).select(F.col("name").alias(key), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("component_id") == F.col("name"), F.lit(False)).alias("kept"))


def op3_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles at 0.8."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, shingle=2, percent=80)
