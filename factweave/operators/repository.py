"""Documents of a code repository as units of text: sections of Markdown, rows of its
tables as sentences; and prompts changed line by line."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def markdown_sections(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, heading, body) of the sections under second-level headings; what
    stands before the first is the ``overview``, left out if it is blank."""
    white = F.lit(" \t\r\n\x0b\x0c")
    parts = F.split(F.concat(F.lit("\n"), F.replace(text, F.lit("\r\n"), F.lit("\n"))), "\n## ")
    rows = docs.select(key, F.posexplode(parts).alias("place", "part"))
    first = F.col("place") == 0
    heading = F.when(first, "overview").otherwise(F.btrim(F.substring_index("part", "\n", 1), white))
    body = F.btrim(F.when(first, F.col("part")).otherwise(F.regexp_extract("part", r"(?s)^[^\n]*\n(.*)$", 1)), white)
    return rows.select(key, "place", heading.alias("heading"), body.alias("body")).where("place > 0 or body <> ''")


def table_facts(text: Column) -> Column:
    """Rows of the Markdown tables in a text as sentences, in order. A table is a row of
    headers, a row of dashes and the rows below; empty cells and dashes are left out, and
    so are rows of another width."""
    blocks = F.regexp_extract_all(text, F.lit(r"((?:(?:^|(?<=\n))[ \t]*\|[^\n]*(?:\n|\z))+)"), 1)

    def cells(line: Column) -> Column:
        return F.transform(F.split(F.btrim(F.trim(line), F.lit("|")), r"\|"), lambda c: F.trim(c))

    # The form of a sentence, "- Table row: a=1, b=2.".
    def facts(block: Column) -> Column:
        lines = F.split(F.btrim(block, F.lit("\n")), "\n")
        at = F.array_min(F.filter(F.sequence(F.lit(0), F.size(lines)), lambda i: F.coalesce(F.contains(F.get(lines, i + 1), F.lit("-")), F.lit(False))))
        names = cells(F.get(lines, at))

        def fact(line: Column) -> Column:
            own = cells(line)
            pairs = F.filter(F.zip_with(names, own, lambda n, v: F.when((v != "") & (v != "-"), F.concat(n, F.lit("="), v))), lambda p: p.isNotNull())
            return F.when((F.size(own) == F.size(names)) & (F.size(pairs) > 0), F.concat(F.lit("- Table row: "), F.array_join(pairs, ", "), F.lit(".")))

        return F.filter(F.transform(F.filter(lines, lambda _, i: i > at + 1), fact), lambda f: f.isNotNull())

    return F.flatten(F.transform(blocks, facts))


def mutated(content: Column, remove: Sequence[str] = (), unspaced: Sequence[str] = (), replace: Mapping[str, str] | None = None) -> Column:
    """Text with lines replaced (by the first prefix that fits), lines removed by prefix,
    and the blank line before a line with a prefix of ``unspaced`` taken out, in that
    order."""
    lines = F.split(content, "\n")

    def begins(line: Column, prefixes: Sequence[str]) -> Column:
        out = F.lit(False)
        for prefix in prefixes:
            out = out | line.startswith(prefix)
        return F.coalesce(out, F.lit(False))

    def replaced(line: Column) -> Column:
        out = line
        for prefix, text in reversed(list((replace or {}).items())):
            out = F.when(line.startswith(prefix), F.lit(text)).otherwise(out)
        return out

    kept = F.filter(F.transform(lines, replaced), lambda x: ~begins(x, remove))
    return F.array_join(F.filter(kept, lambda x, i: ~((x == "") & begins(F.get(kept, i + 1), unspaced))), "\n")
