"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1; the vectors of an n-gram's letters,
permuted by their place, are bound by multiplication, and a text is the bundle (sum) of
its n-grams' vectors. A language's prototype is the bundle of its training texts' unit
vectors. A text gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import _words
from factweave.llm._store import bounded_batches, written

DIMENSIONS = 1024
ORDER = 3
#: Distinct n-grams whose vectors are held at a time.
GRAMS = 8_192
#: Prototypes are learned from about this many texts of each language at most.
SAMPLE_ROWS = 3_000
#: Prototypes that one pass over the texts compares them with; more take further passes.
BLOCK = 4_096
#: Languages whose partial prototypes one task holds at a time.
HELD = 1_024
#: Frequent languages up to which their shares are broadcast.
BROADCAST_LANGUAGES = 100_000
#: Steepness of the score: share of exp(SCALE x cosine) among the languages.
SCALE = 40.0

_LETTERS: list[np.ndarray] = []
_VECTORS: dict[int, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Code point -> lower-cased letter, 0 if it is no letter."""
    if not _LETTERS:
        table = np.zeros(0x110000, np.uint32)
        for code in range(0x32000):
            char = chr(code)
            if unicodedata.category(char)[0] == "L":
                low = char.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _LETTERS.append(table)
    return _LETTERS[0]


def _vector(letter: int) -> np.ndarray:
    if letter not in _VECTORS:
        _VECTORS[letter] = (np.random.default_rng(letter).integers(0, 2, DIMENSIONS) * 2 - 1).astype(np.int8)
    return _VECTORS[letter]


def encode(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vector of each text, and whether it has a letter. n-grams run over
    lower-cased letters, with one gap symbol for whatever stands between words and at
    either end of the text."""
    data, offsets = _words.raw(text)
    string = data.tobytes().decode("utf-8")
    bounds = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    letters = _letters()[np.frombuffer(string.encode("utf-32-le"), np.uint32)]
    texts = len(bounds) - 1
    out = np.zeros((texts, DIMENSIONS), np.float32)
    # Two gaps after each text keep n-grams from reaching into the next one.
    owner = np.repeat(np.arange(texts), np.diff(bounds))
    row = np.zeros(len(letters) + 2 * texts + 1, np.uint32)
    row[1 + np.arange(len(letters)) + 2 * owner] = letters
    own = np.zeros(len(row), np.int64)
    ends = bounds[1:] + 2 * np.arange(1, texts + 1)
    own[1:] = np.searchsorted(ends, np.arange(len(row) - 1), side="right")
    drop = np.zeros(len(row), bool)
    drop[1:] = (row[1:] == 0) & (row[:-1] == 0) & (own[1:] == own[:-1])
    row, own = row[~drop], own[~drop]
    has = np.zeros(texts, bool)
    has[own[row != 0]] = True
    if len(row) < ORDER:
        return out, has
    alphabet, symbols = np.unique(row, return_inverse=True)
    symbols = symbols.astype(np.int64)
    n = len(row) - ORDER + 1
    grams = np.zeros(n, np.int64)
    for i in range(ORDER):
        grams = grams * len(alphabet) + symbols[i : i + n]
    middle = row[1 : 1 + n] != 0
    grams, of = grams[middle], own[1 : 1 + n][middle]
    unique, index = np.unique(grams, return_inverse=True)
    digits = [(unique // len(alphabet) ** (ORDER - 1 - i)) % len(alphabet) for i in range(ORDER)]
    base = np.stack([_vector(int(a)) for a in alphabet])
    rolled = [np.roll(base, i, axis=1) for i in range(ORDER)]
    for low in range(0, len(unique), GRAMS):
        high = min(low + GRAMS, len(unique))
        vectors = rolled[0][digits[0][low:high]]
        for i in range(1, ORDER):
            vectors *= rolled[i][digits[i][low:high]]
        vectors = vectors.astype(np.float32)
        here = slice(None) if len(unique) <= GRAMS else np.flatnonzero((index >= low) & (index < high))
        own, gram, wide = of[here], index[here] - low, high - low
        step = max(1, 1_000_000 // wide)
        edges = np.searchsorted(own, np.arange(0, texts + step, step))
        for k in range(len(edges) - 1):
            first, last = k * step, min(texts, (k + 1) * step)
            part = slice(edges[k], edges[k + 1])
            counts = np.bincount((own[part] - first) * wide + gram[part], minlength=(last - first) * wide).astype(np.float32)
            out[first:last] += counts.reshape(last - first, wide) @ vectors
    return out, has


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _sums(batches: Iterator[tuple[list[str], np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Sums of vectors for each name, of HELD names at a time."""
    held: dict[str, np.ndarray] = {}

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["lang", "vector"])

    for names, vectors in batches:
        order = np.argsort(np.asarray(names, object), kind="stable")
        named = [names[i] for i in order]
        starts = [i for i, n in enumerate(named) if not i or n != named[i - 1]]
        for a, b in zip(starts, [*starts[1:], len(named)], strict=True):
            if named[a] not in held and len(held) >= HELD:
                yield flush()
                held.clear()
            held[named[a]] = held.get(named[a], 0) + vectors[order[a:b]].sum(0, dtype=np.float64)
    if held:
        yield flush()


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(lang, vector) with the prototype of each language of ``docs``, a row each.

    Rows with a null text or language are left out, and a text that repeats within a
    language counts once. Of a language with more than ``sample_rows`` rows, those whose
    hashed text is small are taken, about that many at most. Every language is learned,
    however many there are: tasks sum their texts' vectors by language, HELD languages at
    a time, and the sums meet by language.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    frequent = written(labelled.groupBy("lang").count().where(F.col("count") > sample_rows))
    if frequent.count() <= BROADCAST_LANGUAGES:
        frequent = F.broadcast(frequent)
    share = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / 1_000_003
    sample = labelled.join(frequent, "lang", "left").where(F.col("count").isNull() | (share * F.col("count") < sample_rows)).select("lang", "text").distinct()

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (chunk for batch in batches for chunk in _words.chunks(batch, "text"))
        return _sums((chunk.column("lang").to_pylist(), _unit(encode(chunk.column("text"))[0])) for chunk in chunks)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sums((b.column("lang").to_pylist(), np.frombuffer(b"".join(b.column("vector").to_pylist()), np.float64).reshape(-1, DIMENSIONS)) for b in batches if b.num_rows)

    # A task has a language's rows side by side, so it holds few at a time and ends each once.
    partial = bounded_batches(sample).mapInArrow(bundle, "lang string, vector binary")
    met = partial.repartition("lang").sortWithinPartitions("lang").mapInArrow(total, "lang string, vector binary")
    return written(met)


def prototypes(learned: DataFrame, after: str | None = None) -> dict[str, np.ndarray]:
    """The next BLOCK prototypes in order of language."""
    rows = learned if after is None else learned.where(F.col("lang") > after)
    out: dict[str, np.ndarray] = {}
    for row in rows.orderBy("lang").limit(BLOCK).toLocalIterator():
        out[row["lang"]] = np.frombuffer(row["vector"], np.float64)
    return out


def predict(docs: DataFrame, learned: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``cosine``: the language of the nearest
    prototype, its share of exp(SCALE x cosine) among all, and its cosine.

    A null text and one without a letter is ``und`` with score and cosine 0; with no
    prototypes every text is. Ties go to the language that sorts first. Columns of these
    names are replaced. Texts are compared with BLOCK prototypes at a time (16 MB, which
    each task holds); each further block reads the texts again. A text takes some 60 times
    its bytes while it is encoded, whole.
    """
    made = ("lang_pred", "score", "cosine")
    rest = [c for c in docs.columns if c not in made]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    kind = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, best double, rest double"
    # Nearest so far, its cosine, and the sum of exp(SCALE x (cosine - best)) so far.
    now = rows.select("row", F.lit(None).cast("string").alias("lang_pred"), F.lit(-2.0).alias("best"), F.lit(0.0).alias("rest"))

    def against(names: list[str], matrix: np.ndarray):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk in _words.chunks(batch, "text"):
                    vectors, has = encode(chunk.column("text"))
                    cosine = _unit(vectors) @ matrix.T
                    near = cosine.argmax(1)
                    here = cosine[np.arange(len(near)), near].astype(np.float64)
                    sums = np.exp(SCALE * (cosine - here[:, None])).sum(1)
                    old, before = chunk.column("best").to_numpy(), chunk.column("rest").to_numpy()
                    best = np.maximum(old, here)
                    found = np.where(here > old, np.asarray(names, object)[near], np.asarray(chunk.column("lang_pred").to_pylist(), object))
                    total = before * np.exp(SCALE * (old - best)) + sums * np.exp(SCALE * (here - best))
                    found[~has] = None
                    yield pa.RecordBatch.from_arrays([chunk.column("row"), pa.array(found.tolist(), pa.string()), pa.array(best), pa.array(total)], ["row", "lang_pred", "best", "rest"])

        return work

    block = prototypes(learned)
    while block:
        names = list(block)
        told = now.select("*", F.col("row").getField(text).cast("string").alias("text"))
        now = bounded_batches(told).mapInArrow(against(names, _unit(np.stack([block[n] for n in names])).astype(np.float32)), kind)
        block = prototypes(learned, names[-1]) if len(names) == BLOCK else {}
        if block:
            now = written(now)
    known = F.col("lang_pred").isNotNull()
    score = F.when(known, F.least(F.lit(1.0), 1 / F.col("rest"))).otherwise(0.0)
    return now.select("row.*", F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), score.alias("score"), F.when(known, F.col("best")).otherwise(0.0).alias("cosine"))


def held_out(key: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text has this remainder; a null key has none."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(False))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a fifth of them is held out of learning."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = learn(docs.where(~held_out("doc_id", 5, 0)))
    found = predict(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")
