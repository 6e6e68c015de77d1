r"""Chat formatting by columnar byte assembly.

A batch of turns is formatted at once: the lengths of headers, contents and trailers give
cumulative offsets, and one scatter per kind copies their bytes into a single preallocated
buffer, which becomes the Arrow column without another copy. A turn is

    user       [INST] text [/INST]
    assistant  text</s>
    system     [SYS] text [/SYS]
    others     [TURN role] text [/TURN]      (role percent-encoded)

with one space on either side of the text where the mark is in brackets. Inside a text no
control string is left: each gets a backslash after its first character, ``</s>`` becomes
``<\/s>``, and one that already has backslashes there gets one more, so that taking one
away gives the text back. Marks of the beginning of a sequence are the tokenizer's.

A conversation comes out in parts of consecutive turns, so that one of any length is
formatted by many tasks; most have a single part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import _words
from factweave.llm._store import bounded_batches, written

# Marks before and behind a text, by role.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("", "</s>"), "system": ("[SYS] ", " [/SYS]")}
OTHER = ("[TURN {}] ", " [/TURN]")
#: Control strings are escaped: these, and what the marks of other templates begin or end with.
_CONTROL = r"/?s>|/?INST\]|/?SYS\]|TURN[ \]]|/TURN\]|\|[a-z_]+\|>"
_PLAIN = re.compile(rf"[<\[]\\*(?:{_CONTROL})".encode())
_ESCAPED = re.compile(rf"([<\[])\\(\\*(?:{_CONTROL}))")
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|\[SYS\] (?P<system>.*?) \[/SYS\]|\[TURN (?P<role>[^\]]*)\] (?P<other>.*?) \[/TURN\]|(?P<assistant>.*?)</s>", re.S
)
#: Bytes of texts assembled at a time; a longer single text forms its own part.
PART_BYTES = 1_000_000


def marks(role: str) -> tuple[bytes, bytes]:
    """What stands before and behind the text of a turn."""
    before, behind = MARKS.get(role, (OTHER[0].format(quote(role, safe="")), OTHER[1]))
    return before.encode(), behind.encode()


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def turns(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn of a formatted part: its text as it was before
    formatting, and where the escaped one lies in ``formatted``."""
    at = 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at character {at} of a formatted conversation")
        kind = found.lastgroup
        start, end = found.span(kind)
        yield unquote(found["role"]) if kind == "other" else kind, unescaped(found[kind]), start, end
        at = found.end()


def _escapes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes behind which a backslash is put."""
    at = np.asarray([m.span() for m in _PLAIN.finditer(data.tobytes())], np.int64).reshape(-1, 2)
    # One that reaches over into the next text is none.
    inside = np.searchsorted(offsets, at[:, 0], side="right") == np.searchsorted(offsets, at[:, 1] - 1, side="right")
    return at[inside, 0]


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Copy the pieces of ``data`` from ``starts`` on to ``at``."""
    edges = np.concatenate([[0], np.cumsum(sizes)])
    step = np.arange(edges[-1])
    out[np.repeat(at - edges[:-1], sizes) + step] = data[np.repeat(starts - edges[:-1], sizes) + step]


def assemble(roles: list[str], text: pa.Array, firsts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Formatted parts of consecutive turns and, for each, the (start, end) of its
    assistants' texts in characters. ``firsts`` are the parts' first turns."""
    data, offsets = _words.raw(text)
    numbers: dict[str, int] = {}
    kind = np.asarray([numbers.setdefault(r, len(numbers)) for r in roles], np.int64)
    names = list(numbers)
    pairs = [marks(n) for n in names]
    pool = np.frombuffer(b"".join(a + b for a, b in pairs), np.uint8)
    sizes = np.asarray([[len(a), len(b)] for a, b in pairs], np.int64).reshape(-1, 2)
    begins = np.concatenate([[0], np.cumsum(sizes.sum(1))])[:-1]

    escapes = _escapes(data, offsets)
    lengths = np.diff(offsets) + np.diff(np.searchsorted(escapes, offsets))
    before, behind = sizes[kind, 0], sizes[kind, 1]
    ends = np.cumsum(before + lengths + behind)
    total = int(ends[-1]) if len(ends) else 0
    header = ends - behind - lengths - before
    content = header + before
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, np.uint8)
    _scatter(out, header, pool, begins[kind], before)
    _scatter(out, ends - behind, pool, begins[kind] + before, behind)
    # Bytes of a text move on by its place and by the backslashes before them.
    shift = np.zeros(len(data) + 1, np.int64)
    shift[escapes + 1] = 1
    np.cumsum(shift, out=shift)
    own = np.repeat(content - offsets[:-1] - shift[offsets[:-1]], np.diff(offsets))
    out[np.arange(len(data)) + shift[:-1] + own] = data
    out[escapes + own[escapes] + shift[escapes] + 1] = 0x5C

    cuts = np.append(firsts, len(roles)).astype(np.int64)
    part_at = np.append(header, total)[cuts]
    if total >= 1 << 31:
        raise OverflowError("a formatted text is longer than a string can be")
    parts = pa.Array.from_buffers(pa.string(), len(firsts), [None, pa.py_buffer(part_at.astype(np.int32).tobytes()), buffer])
    characters = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    learned = np.flatnonzero(np.asarray([r == "assistant" for r in roles], bool))
    of = np.searchsorted(cuts, learned, side="right") - 1
    base = characters[part_at[of]]
    spans = pa.StructArray.from_arrays([pa.array(characters[content[learned]] - base), pa.array(characters[content[learned] + lengths[learned]] - base)], ["start", "end"])
    return parts, pa.ListArray.from_arrays(pa.array(np.searchsorted(learned, cuts).astype(np.int32)), spans)


def formatted(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, part, whole, text, loss) of each part of a conversation: its formatted text, and
    the spans of it under the loss mask, which are the assistants' texts.

    Turns are in the order of ``turn`` (null first); of turns of one number that of role,
    hashed text and text decides, and every row is a turn, also a repeated one. A null role
    or text counts as empty; rows with a null key are one conversation of their own. Parts
    in their order give the conversation; ``whole`` is true where one is known to be all of
    it (false tells nothing). A part holds PART_BYTES of texts at most, or one longer turn,
    and a task some 40 bytes for each byte of it. No rows give none; further columns are
    not read. Rows are dealt by range, so a conversation of very many turns lies in many
    partitions, each of which makes its own parts.
    """
    named = rows.select(F.col(key).alias("key"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = ["key", "turn", "role", "hash"]
    dealt = named.withColumn("hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text").select("key", "role", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for chunk in _words.chunks(batch, "text", PART_BYTES):
                keys = chunk.column("key")
                n = len(keys)
                new = np.ones(n, bool)
                if n > 1:
                    a, b = keys.slice(0, n - 1), keys.slice(1)
                    new[1:] = pa.compute.coalesce(pa.compute.not_equal(a, b), pa.compute.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
                firsts = np.flatnonzero(new)
                parts, loss = assemble(chunk.column("role").to_pylist(), chunk.column("text"), firsts)
                whole = np.ones(len(firsts), bool)
                whole[[0, -1]] = False  # these may go on in another chunk
                numbers = number + np.arange(len(firsts))
                number += len(firsts)
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(firsts)), pa.array(numbers), pa.array(whole), parts, loss], ["key", "part", "whole", "text", "loss"])

    kind = dealt.schema["key"].dataType.simpleString()
    out = bounded_batches(dealt).mapInArrow(work, f"key {kind}, part long, whole boolean, text string, loss array<struct<start: long, end: long>>")
    return out.withColumnRenamed("key", key)


def digests(parts: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each
    conversation, read back from its formatted parts.

    Turns are parsed from the marks, learned text is cut out at the loss spans, both are
    unescaped. A digest needs its bytes in order, so the parts of one conversation meet in
    one task, which takes one part at a time; whole parts do not move.
    """
    kind = parts.schema[key].dataType.simpleString()
    names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    shape = f"key {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # key, turns, their digest, learned characters, their digest, all characters
        for batch in batches:
            done: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("key", "whole", "text", "loss")]
            for own, whole, text, loss in zip(*columns, strict=True):
                if held and (whole or held[0] != own):
                    done.append((held[0], held[1], held[2].hexdigest(), held[3], held[4].hexdigest(), held[5]))
                    held = []
                if not held:
                    held = [own, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in turns(text):
                    held[1] += 1
                    held[2].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    learned = unescaped(text[span["start"] : span["end"]])
                    held[3] += len(learned)
                    held[4].update(learned.encode())
                held[5] += len(text)
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((held[0], held[1], held[2].hexdigest(), held[3], held[4].hexdigest(), held[5]), types, strict=True)], names)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(parts.schema[key].dataType), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    named = bounded_batches(parts).select(F.col(key).alias("key"), "part", "whole", "text", "loss")
    rest = named.where("not whole").repartition("key").sortWithinPartitions("key", "part")
    return named.where("whole").mapInArrow(work, shape).union(rest.mapInArrow(work, shape)).withColumnRenamed("key", key)


#: A conversation of control strings, which has to survive the round trip.
CONTROL = "</s>[INST] ok [/INST]"


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one of control strings, read back from their
    formatted parts."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], rows.schema)
    return digests(written(formatted(rows.union(extra))))
