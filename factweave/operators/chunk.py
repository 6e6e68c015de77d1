"""Text chunking: exact character ranges, one row a chunk."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a heading and the break between two paragraphs look like.
HEADING = re.compile(r"(?m)^(#{1,6})[ \t]+(.+?)\s*$")
PARAGRAPH_BREAK = re.compile(r"\n[ \t]*\n+")
#: Soft target, least useful and greatest length of a chunk.
TARGET, LEAST, MOST = 4_000, 1_000, 5_000

Slice = tuple[int, int, tuple[str, ...]]


def sections(text: str) -> list[Slice]:
    """Ranges between headings, each with its path of headings."""
    heads = [(m.start(), len(m[1]), m[2].strip()) for m in HEADING.finditer(text)]
    edges = [h[0] for h in heads] + [len(text)]
    out: list[Slice] = [(0, edges[0], ())] if edges[0] > 0 else []
    path: list[tuple[int, str]] = []
    for (at, level, title), end in zip(heads, edges[1:], strict=True):
        path = [p for p in path if p[0] < level] + [(level, title)]
        out.append((at, end, tuple(t for _, t in path)))
    return out


def paragraphs(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Ranges between blank lines inside [start, end)."""
    part, at, out = text[start:end], 0, []
    for m in PARAGRAPH_BREAK.finditer(part):
        if m.start() > at:
            out.append((start + at, start + m.start()))
        at = m.end()
    if at < len(part):
        out.append((start + at, end))
    return out


def windows(text: str, start: int, end: int, least: int = LEAST, most: int = MOST) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most`` characters, ended at a line break or else a space that
    leaves ``least``."""
    while end - start > most:
        low, high = min(start + least, start + most), start + most
        cut = next((c for c in (text.rfind("\n", low, high), text.rfind(" ", low, high)) if c > start), high)
        yield start, cut
        start = cut
    if end > start:
        yield start, end


def _merged(parts: Iterable[Slice], target: int, least: int, most: int) -> Iterator[Slice]:
    """Neighbouring ranges joined while they stay in bounds; the first one's path stays.
    A range above ``most`` stands alone."""
    held: Slice | None = None
    for start, end, path in parts:
        if held and end - start <= most and end - held[0] <= most and (end - held[0] <= target or held[1] - held[0] < least):
            held = (held[0], end, held[2])
            continue
        if held:
            yield held
        held = (start, end, path)
        if end - start > most:
            yield held
            held = None
    if held:
        yield held


def split(text: str, target: int = TARGET, least: int = LEAST, most: int = MOST) -> list[Slice]:
    """Chunks of a text: sections merged up to the target; a larger section by
    paragraphs, a larger paragraph by windows."""
    out: list[Slice] = []
    for start, end, path in _merged(sections(text), target, least, most):
        if end - start <= most:
            out.append((start, end, path))
            continue
        for a, b, _ in _merged([(a, b, path) for a, b in paragraphs(text, start, end)], target, least, most):
            out += [(a, b, path)] if b - a <= most else [(x, y, path) for x, y in windows(text, a, b, least, most)]
    return out


def overlapping(text: str, target: int = 3_000, overlap: int = 200) -> list[str]:
    """Paragraphs joined up to ``target`` characters; a chunk begins with the last
    paragraphs of the one before, as many as fit into ``overlap``."""
    if len(text) <= target:
        return [text]
    out, held, size = [], [], 0
    for paragraph in text.split("\n\n"):
        n = len(paragraph) + 2
        if held and size + n > target:
            out.append("\n\n".join(held))
            kept, total = [], 0
            for p in reversed(held):
                if total + len(p) > overlap:
                    break
                kept.insert(0, p)
                total += len(p)
            held, size = kept, total
        held.append(paragraph)
        size += n
    return [*out, "\n\n".join(held)]


def chunks(docs: DataFrame, key: str, text: str, target: int = TARGET, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(key, chunk_id, char_start, char_end, heading_path, content) of each document that
    is not blank."""
    if not least <= target <= most:
        raise ValueError("least <= target <= most")
    rows = docs.where(F.trim(F.col(text)) != "").select(F.col(key).alias("key"), F.col(text).alias("text"))

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            made = [(k, f"chunk_{i:03d}", a, b, list(p), t[a:b]) for k, t in zip(part["key"], part["text"], strict=True) for i, (a, b, p) in enumerate(split(t, target, least, most), 1)]
            yield pd.DataFrame(made, columns=["key", "chunk_id", "char_start", "char_end", "heading_path", "content"])

    out = rows.mapInPandas(work, f"key {rows.schema['key'].dataType.simpleString()}, chunk_id string, char_start long, char_end long, heading_path array<string>, content string")
    return out.withColumnRenamed("key", key)


def overlap_chunks(docs: DataFrame, key: str, text: str, target: int = 3_000, overlap: int = 200) -> DataFrame:
    """(key, place, content) of the overlapping chunks of each text; a null text has none."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            made = [(k, i, c) for k, t in zip(part["key"], part["text"], strict=True) for i, c in enumerate(overlapping(t, target, overlap))]
            yield pd.DataFrame(made, columns=["key", "place", "content"])

    out = rows.mapInPandas(work, f"key {rows.schema['key'].dataType.simpleString()}, place int, content string")
    return out.withColumnRenamed("key", key)
