"""Recorded model responses as candidates: JSON in its known broken shapes, spans quoted
loosely, and guards on what must not pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.functions import payload

# Abstract objects of a limited capability, and marks of staffing summaries.
ABSTRACT_CAPABILITIES = ["effectiveness", "impact", "credibility"]
STAFFING_MEMBERS = ["personnel assigned to", "personnel dedicated to"]
STAFFING_EVIDENCE = ["substantial proportion dedicated to", "total strength was reported"]
LIMIT_CAPABILITY, MEMBERSHIP = "oc:limit_capability", "oc:belongs_to_organization"


def unfenced(text: Column) -> Column:
    """Text inside a code fence, else the text."""
    inside = F.regexp_extract(text, r"(?s)```(?:[a-zA-Z]*)\s*\n(.*?)\n?\s*```", 1)
    return F.trim(F.when(inside != "", inside).otherwise(text))


def _given(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) != ""


def filler_ok(f: Column) -> Column:
    """Whether a filler has what its kind asks for."""
    kind = F.trim(f["kind"])
    return F.coalesce(
        F.when(kind == "entity", _given(f["entity_id"]) | _given(f["name"]))
        .when(kind == "value", _given(f["value_kind"]) & (f["normalized"].isNotNull() | _given(f["raw"])))
        .when(kind == "unknown", _given(f["raw"])),
        F.lit(False),
    )


def candidates(responses: DataFrame, key: str, text: str) -> DataFrame:
    """(key, position, predicate, roles) of the usable candidates of each response.

    A predicate that holds the whole assertion as JSON, or as ``id | roles={..}``, is
    taken apart; a single filler counts as a list of one; ``value`` names an entity that
    has no name. A candidate with a broken envelope, an unfit filler, a blank role or no
    role is left out, the others of its response stay. Null, empty and non-JSON
    responses have none.
    """
    listed = F.from_json(unfenced(F.col(text)), "candidates array<string>", {"mode": "PERMISSIVE"})["candidates"]
    rows = responses.select(F.col(key).alias("key"), F.posexplode(listed).alias("position", "c"))
    given = rows.select("key", "position", F.trim(F.get_json_object("c", "$.predicate")).alias("said"), F.get_json_object("c", "$.roles").alias("roles"))
    packed = F.col("said").startswith("{")
    split = F.split("said", r"\| roles=", 2)
    said = F.when(packed, F.get_json_object("said", "$.predicate_id")).otherwise(F.trim(split[0]))
    inner = F.when(packed, F.get_json_object("said", "$.roles")).otherwise(F.get(split, F.lit(1)))
    own = F.when(F.col("roles").isNotNull() & (F.col("roles") != "{}"), F.col("roles")).otherwise(inner)
    entries = F.from_json(own, "map<string,string>")

    def fillers(value: Column) -> Column:
        many = F.from_json(F.when(value.startswith("["), value).otherwise(F.concat(F.lit("["), value, F.lit("]"))), f"array<{payload.FILLER}>")
        return F.transform(many, lambda f: f.withField("name", F.coalesce(f["name"], F.when(F.trim(f["kind"]) == "entity", f["value"]))))

    parsed = given.select("key", "position", said.alias("predicate"), F.transform_values(entries, lambda _, v: fillers(v)).alias("roles"))
    fit = F.forall(F.map_values("roles"), lambda v: v.isNotNull() & F.forall(v, filler_ok))
    kept = parsed.where(_given(F.col("predicate")) & payload.roles_are_valid(F.col("roles")) & fit)
    return kept.withColumnRenamed("key", key)


def resolve_span(text: Column, quote: Column) -> Column:
    """(start, end, text) of the first place where the quote stands if white space and
    the marks of emphasis and tables count alike; null where it does not stand. The
    expression is a pattern for each row, searched by the JVM."""
    gap = r"[\s*_`|]+"
    words = F.filter(F.split(quote, gap), lambda w: w != "")
    pattern = F.array_join(F.transform(words, lambda w: F.concat(F.lit(r"\Q"), F.replace(w, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))), gap)
    found = F.regexp_substr(text, pattern)
    start = F.regexp_instr(text, pattern) - 1
    return F.when((F.size(words) > 0) & found.isNotNull(), F.struct(start.alias("start"), (start + F.length(found)).alias("end"), found.alias("text")))


def limits_abstract_capability(predicate: Column, roles: Column) -> Column:
    """Whether a limited capability is only an abstract one: all its fillers are values
    of that list."""
    fillers = F.coalesce(F.try_element_at(roles, F.lit("capability")), F.array().cast(f"array<{payload.FILLER}>"))
    chosen = lambda f: F.lower(F.trim(F.when(_given(f["normalized"]), f["normalized"]).otherwise(f["raw"])))
    every = F.forall(fillers, lambda f: F.coalesce((f["kind"] == "value") & chosen(f).isin(*ABSTRACT_CAPABILITIES), F.lit(False)))
    return F.coalesce((predicate == LIMIT_CAPABILITY) & (F.size(fillers) > 0) & every, F.lit(False))


def staffing_summary(predicate: Column, roles: Column, spans: Column) -> Column:
    """Whether a membership only sums up staff: its one member and its evidence (an array
    of texts) both speak of numbers of personnel."""
    fillers = F.coalesce(F.try_element_at(roles, F.lit("member")), F.array().cast(f"array<{payload.FILLER}>"))
    member = F.get(fillers, F.lit(0))
    said = F.lower(F.concat_ws("\n", member["name"], member["raw"]))

    def any_of(text: Column, marks: list[str]) -> Column:
        return F.exists(F.array(*map(F.lit, marks)), lambda m: F.contains(text, m))

    out = (predicate == MEMBERSHIP) & (F.size(fillers) == 1) & (member["kind"] == "entity") & any_of(said, STAFFING_MEMBERS) & F.exists(spans, lambda s: any_of(F.lower(s), STAFFING_EVIDENCE))
    return F.coalesce(out, F.lit(False))


def judged(candidates: DataFrame, judgments: DataFrame, key: list[str]) -> DataFrame:
    """Candidates with ``label``: what the recorded judge said of them, ``unsupported``
    where a guard holds (columns ``guarded``), ``unjudged`` where nothing was said."""
    out = candidates.join(judgments, key, "left")
    return out.withColumn("label", F.when(F.col("guarded"), "unsupported").otherwise(F.coalesce("label", F.lit("unjudged"))))
