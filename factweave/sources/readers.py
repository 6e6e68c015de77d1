"""Sources: JSON lines, documents, packs, profiles and importers of claims."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from factweave.functions import text as T

# Roles by position, and scores of confidence labels and corroboration.
POSITIONAL_ROLES = ("subject", "object", "indirect_object", "modifier")
LABEL_SCORES = {"high": 0.9, "medium": 0.7, "low": 0.4}
# Content tables of an ontology pack.
PACK_TABLES = ("predicate_types", "role_types", "predicate_role_edges", "constraints", "hierarchy_edges", "aliases", "source_mappings", "entity_types", "value_types")


def json_lines(spark: SparkSession, path: str, schema: StructType | str, check: bool = True) -> DataFrame:
    """JSON lines of a known schema; blank lines are skipped, a broken one is an error.

    ``check`` reads the files once before, so that the error names the file and the number
    of the line; without it a broken line fails when it is read."""
    if check:
        kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        told = spark.read.schema(StructType([*kind.fields, StructField("_broken", StringType())])).option("columnNameOfCorruptRecord", "_broken").json(path)
        # All columns are kept: Spark parses only what is asked for.
        bad = told.select("*", F.col("_metadata.file_path").alias("_file")).where("_broken is not null").first()
        if bad is not None:
            # Lines of one file come in order; only a file with a broken line is counted.
            number = spark.read.text(bad["_file"]).rdd.map(lambda r: r[0]).zipWithIndex().filter(lambda x: x[0] == bad["_broken"]).first()[1] + 1
            raise ValueError(f"{bad['_file']}, line {number}: not a JSON object of the schema: {bad['_broken'][:80]}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def whole_documents(spark: SparkSession, path: str) -> DataFrame:
    """(source_ref, text): a row for each file below ``path``."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_ref"), F.col("value").alias("text"))


def yaml_object(path: str) -> dict:
    """A small manifest on the driver."""
    try:
        import yaml
    except ImportError:
        return json.loads(Path(path).read_text())
    value = yaml.safe_load(Path(path).read_text())
    if not isinstance(value, dict):
        raise ValueError(f"{path} is not an object")
    return value


def ontology_pack(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a pack by name; all of them must be there."""
    return {name: spark.read.json(f"{folder}/{name}.jsonl") for name in PACK_TABLES}


def active(rows: DataFrame) -> DataFrame:
    """Rows whose status is active, as it is when none is given."""
    return rows.where(F.lower(F.coalesce("status", F.lit("active"))) == "active")


def effective_predicates(allowed: DataFrame, overlay: DataFrame) -> DataFrame:
    return allowed.select("predicate").unionByName(overlay.select("predicate")).distinct()


def shared_claims(claims: DataFrame) -> DataFrame:
    """Candidates of claims (claim_id, claim_type, predicate, statement, entity_refs):
    entities fill roles by position, further ones argN."""
    at = F.col("pos")
    role = F.coalesce(F.get(F.array(*map(F.lit, POSITIONAL_ROLES)), at), F.concat(F.lit("arg"), at))
    rows = claims.select("claim_id", F.coalesce(F.when(F.trim("predicate") != "", F.col("predicate")), F.concat(F.lit("shared:"), "claim_type")).alias("predicate"), "statement", F.posexplode_outer("entity_refs").alias("pos", "entity"))
    return rows.select("claim_id", "predicate", "statement", role.alias("role_id"), "entity")


def research_roles(position: Column) -> Column:
    """ARG0, ARG1, participant_2, .."""
    return F.when(position < 2, F.concat(F.lit("ARG"), position)).otherwise(F.concat(F.lit("participant_"), position))


# Predicates of claim types, and confidence by label and by corroboration.
CLAIM_PREDICATES = {"fact_claim": "rv3:asserts_fact", "relationship_claim": "rv3:asserts_relationship", "financial_claim": "rv3:asserts_financial", "temporal_claim": "rv3:asserts_temporal"}


def research_graph(claims: DataFrame, entities: DataFrame, types: dict[str, str], confidence: Column, graph_ref: str, producer: str = "research") -> DataFrame:
    """Candidates of a research graph, one for each claim with a statement: (claim_id,
    predicate, roles, confidence, corroboration, source_kind, source_ref, source_label,
    retrieved_at, claim_text).

    ``claims`` has (claim_id, statement, claim_type, entity_refs, source_url, source_type,
    retrieved_at, corroboration), ``entities`` (entity_ref, schema, names), ``confidence`` is
    an expression over claims. Entities fill roles by their place in ``entity_refs``, in
    that order; an entity that the graph does not hold is a Thing named "unknown", one
    without a name has its id. A claim type that is not known asserts a fact; without an
    address the source is the graph itself. ``producer`` names who made the graph."""
    told = claims.where(F.coalesce("statement", F.lit("")) != "").withColumn("confidence", confidence)
    refs = told.select("claim_id", F.posexplode("entity_refs").alias("pos", "entity_ref")).join(entities.withColumn("known", F.lit(True)), "entity_ref", "left")
    name = F.coalesce(F.get("names", F.lit(0)), F.when(F.col("known"), F.col("entity_ref")), F.lit("unknown"))
    filler = F.struct(F.lit("entity").alias("kind"), schema_type(F.coalesce("schema", F.lit("Thing")), types).alias("entity_type"), name.alias("name"))
    roles = refs.groupBy("claim_id").agg(F.array_sort(F.collect_list(F.struct("pos", research_roles(F.col("pos")).alias("role_id"), filler.alias("filler")))).alias("r"))
    roles = roles.select("claim_id", F.transform("r", lambda x: F.struct(x["role_id"].alias("role_id"), x["filler"].alias("filler"))).alias("roles"))
    table = F.create_map(*[F.lit(x) for pair in CLAIM_PREDICATES.items() for x in pair])
    rows = told.join(roles, "claim_id", "left")
    return rows.select(
        "claim_id",
        F.coalesce(table[F.coalesce("claim_type", F.lit("fact_claim"))], F.lit("rv3:asserts_fact")).alias("predicate"),
        F.coalesce("roles", F.array().cast(roles.schema["roles"].dataType)).alias("roles"),
        "confidence", "corroboration",
        F.concat(F.lit(f"{producer}:"), F.coalesce("source_type", F.lit("unknown"))).alias("source_kind"),
        F.when(F.coalesce("source_url", F.lit("")) != "", F.col("source_url")).otherwise(F.lit(graph_ref)).alias("source_ref"),
        F.concat(F.lit(f"{producer} claim "), F.coalesce("claim_id", F.lit("unknown"))).alias("source_label"),
        "retrieved_at", F.col("statement").alias("claim_text"),
    )


def entity_records(records: DataFrame, investigation: str | None = None, source_file: str = "entities.json", confidence: float = 0.5) -> DataFrame:
    """Relationship facts of entity records (position, name, type, relationships: array of
    (entity, type, detail)): (fact_id, number, from, relationship, to, investigation,
    entity_type, confidence, source_file, detail).

    Facts are numbered from 1 over all records, in order of position and place; an id is a
    slug of the record's name and that number, of three digits or more. Names are trimmed, a
    blank detail is null, a record without relationships gives nothing; none at all raises."""
    rows = records.select("position", "name", "type", F.posexplode("relationships").alias("place", "r"))
    counted = numbered(rows, ["position", "place"])
    if counted.limit(1).isEmpty():
        raise ValueError("the entity records hold no relationship")
    slug = F.btrim(F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "_"), F.lit("_"))
    prefix = F.when(slug == "", "research_agent_rel").otherwise(F.concat(F.lit("ra_"), slug))
    digits = F.when(F.col("number") < 100, F.lpad(F.col("number").cast("string"), 3, "0")).otherwise(F.col("number").cast("string"))
    detail = F.trim("r.detail")
    return counted.select(
        F.concat_ws("_", prefix, digits).alias("fact_id"), "number", F.trim("name").alias("from"), F.trim("r.type").alias("relationship"), F.trim("r.entity").alias("to"),
        F.lit(investigation).cast("string").alias("investigation"), F.col("type").alias("entity_type"), F.lit(confidence).alias("confidence"), F.lit(source_file).alias("source_file"), F.when(detail != "", detail).alias("detail"),
    )


def schema_type(ftm_schema: Column, known: dict[str, str]) -> Column:
    """Type of an entity schema, oc:<lower case> where none is known."""
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(table[ftm_schema], F.concat(F.lit("oc:"), F.lower(ftm_schema)))


def memo_findings(memo: DataFrame, limit: int | None = None) -> DataFrame:
    """Candidates of a memo's findings (source_ref, key_findings); the limit counts before
    blank claims are left out."""
    rows = memo.select("source_ref", F.posexplode("key_findings").alias("i", "f"))
    if limit is not None:
        rows = rows.where(F.col("i") < limit)
    return rows.where(F.trim("f.claim") != "").select(F.concat("source_ref", F.lit(":finding_"), "i").alias("source_ref"), F.trim("f.claim").alias("claim_text"), "f.confidence")


def relationship_facts(facts: DataFrame) -> DataFrame:
    """Role fillers of (id, from, relationship, to) facts; entity ids are slugs."""
    def one(role: str, name: Column, entity: bool) -> Column:
        return F.struct(F.lit(role).alias("role_id"), (F.concat(F.lit("ent:"), T.slug(name)) if entity else F.lit(None).cast("string")).alias("entity_id"), name.alias("name"))

    three = F.array(one("from", F.col("from"), True), one("relationship", F.col("relationship"), False), one("to", F.col("to"), True))
    return facts.select("id", F.explode(three).alias("f")).select("id", "f.*")


def progressive_report(typed: DataFrame, unresolved: DataFrame) -> DataFrame:
    """Candidates of a progressive extraction: typed assertions (event_id, predicate, name,
    coarse_type, refined_type, evidence, source_text) and events without a predicate
    (event_id, name, evidence, source_text), which stay visible as ``unresolved``. An
    entity's type is its refinement, else the coarse one; ``span`` is where the evidence
    first stands in the text, null where it does not."""
    from factweave.functions import payload

    first = typed.withColumn("entity_type", F.coalesce("refined_type", "coarse_type")).withColumn("pass_provenance", F.lit("pass3"))
    second = unresolved.withColumns({"predicate": F.lit("unresolved"), "entity_type": F.lit("Entity"), "pass_provenance": F.lit("pass1")})
    both = first.select("event_id", "predicate", "pass_provenance", "name", "entity_type", "evidence", "source_text").unionByName(second)
    slug = F.replace(F.replace(F.lower("name"), F.lit(" "), F.lit("_")), F.lit("'"), F.lit(""))
    return both.withColumn("entity_id", F.concat(F.lit("ent:progressive:"), slug)).withColumn("span", payload.locate_span(F.col("source_text"), F.col("evidence"))).drop("source_text", "evidence")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``number``, counting all of them from 1 in that order: sorted in
    range partitions, and each partition's places moved on by the rows before it. What is
    broadcast is one count for each partition."""
    from factweave.storage import cut

    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # As many rows as there were partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("number", F.col("offset") + at + 1).drop("part", "offset", "place")


def compiled_vocabulary(predicates: DataFrame, slots: DataFrame) -> dict[str, DataFrame]:
    """Pack tables of a predicate canon: ``predicates`` (predicate_id, label, status) and
    ``slots`` (predicate_id, slot, label, position). Only active predicates go in, a slot
    without a label is left out, and a role is one by its slug, with the least of its
    labels."""
    live = active(predicates).where(F.trim("label") != "")
    own = slots.where(F.trim("label") != "").join(live.select("predicate_id"), "predicate_id", "left_semi").withColumn("role_id", T.slug(F.col("slot")))
    return {
        "predicate_types": live.select("predicate_id", "label").distinct(),
        "role_types": own.groupBy("role_id").agg(F.min("label").alias("label")),
        "predicate_role_edges": own.groupBy("predicate_id", "role_id").agg(F.min("position").alias("position")),
    }


def merged(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files were written under several versions of its schema; what an
    older file lacks is null."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def fixtures(spark: SparkSession, path: str, field: str, schema: StructType | str) -> DataFrame:
    """Entries of the list ``field`` of JSON fixture files, one row each, in their order
    (``place``)."""
    kind = schema if isinstance(schema, str) else schema.simpleString()
    whole = whole_documents(spark, path)
    listed = F.from_json("text", f"`{field}` array<struct<{kind}>>", {"mode": "FAILFAST"})[field]
    return whole.select(F.posexplode(listed).alias("place", "entry")).select("place", "entry.*")


def first_root(spark: SparkSession, roots: Sequence[str], pack: str, version: str, manifest: str = "manifest.yaml") -> str:
    """Folder of a pack in the first of ``roots`` that holds its manifest."""
    context = spark.sparkContext
    for root in roots:
        folder = f"{root.rstrip('/')}/{pack}/{version}"
        path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{manifest}")
        if path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path):
            return folder
    raise FileNotFoundError(f"{pack}@{version} in none of {list(roots)}")


def yaml_objects(spark: SparkSession, path: str) -> DataFrame:
    """(source_ref, json): the object of each YAML file below ``path`` as JSON text with
    sorted keys, parsed on the executors; JSON files are YAML too. A file that holds no
    object is an error. Without a YAML parser, JSON alone is read."""

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            from yaml import safe_load as load
        except ImportError:
            load = json.loads
        for part in parts:
            found = [load(text) for text in part["text"]]
            for ref, value in zip(part["source_ref"], found, strict=True):
                if not isinstance(value, dict):
                    raise ValueError(f"{ref} is not an object")
            yield pd.DataFrame({"source_ref": part["source_ref"], "json": [json.dumps(v, sort_keys=True, default=str) for v in found]})

    return whole_documents(spark, path).mapInPandas(work, "source_ref string, json string")
