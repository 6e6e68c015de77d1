"""Line-level differences of texts, as edits that turn the left one into the right one.

Lines that stand once in either text and in the same order in both are anchors (the longest
such chain); what lies between two anchors is compared by itself, by Myers' greedy search.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits that the search between two anchors goes through at most; what differs by more is
#: replaced whole, which is longer but as right.
MOST_EDITS = 400
EDITS = "array<struct<at: int, removed: array<string>, added: array<string>>>"


def _chain(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (i, j) of lines unique in both, rising in both."""
    once_a, once_b = Counter(a), Counter(b)
    where = {line: j for j, line in enumerate(b) if once_b[line] == 1}
    pairs = [(i, where[line]) for i, line in enumerate(a) if once_a[line] == 1 and line in where]
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        place = bisect_left(tails, j)
        back[k] = at[place - 1] if place else -1
        if place == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[place], at[place] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _greedy(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (i, j) of lines that a shortest edit keeps; none if it takes too many edits."""
    ahead = {1: 0}
    history = []
    for edits in range(min(len(a) + len(b), MOST_EDITS) + 1):
        history.append(dict(ahead))
        for k in range(-edits, edits + 1, 2):
            down = k == -edits or k != edits and ahead[k - 1] < ahead[k + 1]
            i = ahead[k + 1] if down else ahead[k - 1] + 1
            while i < len(a) and i - k < len(b) and a[i] == b[i - k]:
                i += 1
            ahead[k] = i
            if i >= len(a) and i - k >= len(b):
                break
        else:
            continue
        break
    else:
        return []
    kept, i, j = [], len(a), len(b)
    for edits in range(len(history) - 1, -1, -1):
        before, k = history[edits], i - j
        down = k == -edits or k != edits and before.get(k - 1, -1) < before.get(k + 1, -1)
        prior = k + 1 if down else k - 1
        from_i = before[prior] if edits else 0
        from_j = from_i - prior if edits else 0
        while i > from_i and j > from_j and i and j and a[i - 1] == b[j - 1] and (i - 1, j - 1) >= (from_i, from_j):
            i, j = i - 1, j - 1
            kept.append((i, j))
        i, j = from_i, from_j
    return kept[::-1]


def _kept(a: list[str], b: list[str]) -> Iterator[tuple[int, int]]:
    """Places (i, j) of lines that stay, rising in both."""
    work = [(0, len(a), 0, len(b))]
    while work:
        i, m, j, n = work.pop()
        while i < m and j < n and a[i] == b[j]:
            yield i, j
            i, j = i + 1, j + 1
        tail = 0
        while i < m - tail and j < n - tail and a[m - 1 - tail] == b[n - 1 - tail]:
            tail += 1
        same = [(m - tail + k, n - tail + k) for k in range(tail)]
        m, n = m - tail, n - tail
        anchors = _chain(a[i:m], b[j:n]) if i < m and j < n else []
        if anchors:
            edges = [(i, j), *((i + x, j + y) for x, y in anchors), (m, n)]
            work += [(x, p, y, q) for (x, y), (p, q) in zip(edges, edges[1:], strict=False)]
        elif i < m and j < n:
            yield from ((i + x, j + y) for x, y in _greedy(a[i:m], b[j:n]))
        yield from same


def edits(left: str | None, right: str | None) -> list[dict]:
    """Edits (at, removed, added) in order: behind ``at`` lines of the left text, ``removed``
    are replaced by ``added``. A null text has no lines, an empty one has one, empty."""
    a, b = (t.split("\n") if t is not None else [] for t in (left, right))
    out, i, j = [], 0, 0
    for x, y in [*sorted(_kept(a, b)), (len(a), len(b))]:
        if x > i or y > j:
            out.append({"at": i, "removed": a[i:x], "added": b[j:y]})
        i, j = x + 1, y + 1
    return out


def patched(left: str | None, made: list[dict]) -> str | None:
    """The right text again. An edit that does not fit the left text raises."""
    a, out, i = left.split("\n") if left is not None else [], [], 0
    for e in made:
        out += a[i : e["at"]]
        i = e["at"] + len(e["removed"])
        if a[e["at"] : i] != list(e["removed"]):
            raise ValueError(f"the edit behind line {e['at']} does not fit the text")
        out += e["added"]
    out += a[i:]
    return "\n".join(out) if out else None


def compared(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` with ``edits``, which turn the text ``left`` into ``right``. Pairs are worked
    on one at a time; a text of n lines takes some n steps between anchors, and MOST_EDITS
    squared between two of them at most."""
    rest = F.struct(*[F.col(f"`{c}`") for c in pairs.columns if c != "edits"])
    rows = pairs.select(rest.alias("_row"), F.col(left).cast("string").alias("_l"), F.col(right).cast("string").alias("_r"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [edits(a, b) for a, b in zip(batch.column("_l").to_pylist(), batch.column("_r").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(found, kind)], ["_row", "edits"])

    kind = pa.list_(pa.struct([("at", pa.int32()), ("removed", pa.list_(pa.string())), ("added", pa.list_(pa.string()))]))
    return rows.mapInArrow(work, f"_row {rows.schema['_row'].dataType.simpleString()}, edits {EDITS}").select("_row.*", "edits")


def rebuilt(pairs: DataFrame, left: str) -> DataFrame:
    """``pairs`` with ``rebuilt``: what their edits make of the text ``left``."""
    rest = F.struct(*[F.col(f"`{c}`") for c in pairs.columns if c != "rebuilt"])
    rows = pairs.select(rest.alias("_row"), F.col(left).cast("string").alias("_l"), F.col("edits").alias("_e"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [patched(a, e) for a, e in zip(batch.column("_l").to_pylist(), batch.column("_e").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(found, pa.string())], ["_row", "rebuilt"])

    return rows.mapInArrow(work, f"_row {rows.schema['_row'].dataType.simpleString()}, rebuilt string").select("_row.*", "rebuilt")


def unified(left: str, right: str, changes: str = "edits"):
    """Lines of a diff without context (a column): a head for each edit, then what goes and
    what comes."""
    head = lambda e: F.concat(F.lit("@@ -"), e["at"] + 1, F.lit(","), F.size(e["removed"]), F.lit(" +"), F.size(e["added"]), F.lit(" @@"))
    lines = lambda e: F.concat(F.array(head(e)), F.transform(e["removed"], lambda x: F.concat(F.lit("-"), x)), F.transform(e["added"], lambda x: F.concat(F.lit("+"), x)))
    body = F.flatten(F.transform(changes, lines))
    return F.when(F.size(changes) > 0, F.concat(F.array(F.lit(f"--- {left}"), F.lit(f"+++ {right}")), body)).otherwise(F.array().cast("array<string>"))
