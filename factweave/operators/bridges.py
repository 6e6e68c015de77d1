"""Bridges between groups of mentions: edges that deterministic rules add to what a
strategy has grouped.

``mentions`` has (root, entity_id, name, family, context): the group a mention is in, its
surface form, resolution family and the text around it. Every rule is an aggregate per
key with a test that the key names one group only, joined back to the groups it bridges;
no group is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.operators.graph import components
from factweave.storage import cut


def _edges(rows: DataFrame, u: str, v: str) -> DataFrame:
    return rows.where(F.col(u) != F.col(v)).select(F.col(u).alias("u"), F.col(v).alias("v")).distinct()


def signature_edges(mentions: DataFrame) -> DataFrame:
    """Edges (u, v) from each group to the least group of its family that shares a
    signature."""
    keyed = mentions.select("root", "family", F.explode(T.mention_signatures(F.col("name"), F.col("family"))).alias("signature")).distinct()
    least = keyed.groupBy("family", "signature").agg(F.min("root").alias("least"))
    return _edges(keyed.join(least, ["family", "signature"]), "root", "least")


def person_edges(mentions: DataFrame) -> DataFrame:
    """Edges (u, v) that attach groups known by a title with an initial or a surname
    alone to the one group with a full name that fits.

    Titled full names are anchors; where a surname has none, an untitled full name is
    one if it is the surname's only one. A group with several surnames takes no part.
    """
    names = mentions.where("family = 'person'").select("root", T.person_name(F.col("name")).alias("p")).where("p.surname is not null")
    one = names.groupBy("root").agg(F.min("p.surname").alias("surname"), F.count_distinct("p.surname").alias("n")).where("n = 1").select("root", "surname")
    # Both tables are read by all rules below: written once, their names are taken apart once.
    own = names.join(one, "root").select("root", "surname", F.col("p.given").alias("given"), F.col("p.initial").alias("initial"), F.col("p.titled").alias("titled"), F.col("p.surname_only").alias("alone"))
    own = cut(own)
    group = own.groupBy("surname", "root").agg(
        F.max(F.col("given").isNotNull()).alias("full"),
        F.max(F.col("titled") & F.col("given").isNotNull()).alias("titled_full"),
        F.max(F.col("titled") & F.col("initial").isNotNull()).alias("titled_initial"),
        F.max(F.col("titled") & F.col("alone")).alias("titled_alone"),
        F.max(F.col("initial").isNotNull()).alias("any_initial"),
    )
    by_surname = group.groupBy("surname").agg(F.count_if("titled_full").alias("n_titled"), F.count_if("full").alias("n_full"))
    known = cut(group.join(by_surname, "surname"))
    pool = known.where("titled_full or (n_titled = 0 and n_full = 1 and full)")
    anchors = pool.select("surname", F.col("root").alias("anchor"), "titled_initial")
    spelled = own.join(pool.select("surname", "root", "titled_initial"), ["surname", "root"])
    initials = spelled.where("initial is not null and (titled or not titled_initial)").select("surname", F.col("root").alias("anchor"), "initial").distinct()
    weak = known.where("titled_initial and not titled_full").select("surname", "root")
    by_initial = own.where("titled and initial is not null").join(weak, ["surname", "root"], "left_semi").select("surname", "root", "initial").distinct().join(initials, ["surname", "initial"])

    alone = known.where("titled_alone and (n_titled = 1 or n_full = 1)").select("surname", "root", "full", "any_initial")
    titled = own.where("titled").select("surname", F.col("root").alias("anchor"), "given", "initial").distinct()
    bare = alone.where("not full and not any_initial").join(anchors, "surname").select("root", "anchor")
    given = own.where("given is not null").select("surname", "root", "given").distinct().join(alone.where("full"), ["surname", "root"], "left_semi").join(titled, ["surname", "given"])
    short = own.where("initial is not null").select("surname", "root", "initial").distinct().join(alone.where("not full and any_initial"), ["surname", "root"], "left_semi").join(titled, ["surname", "initial"])
    in_pool = given.select("root", "anchor").union(short.select("root", "anchor")).join(anchors.select("anchor"), "anchor", "left_semi").select("root", "anchor")

    def only(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("root").agg(F.min("anchor").alias("anchor"), F.count_distinct("anchor").alias("n")).where("n = 1")

    return _edges(only(by_initial.select("root", "anchor")).union(only(bare.union(in_pool))), "root", "anchor")


def place_edges(mentions: DataFrame) -> DataFrame:
    """Edges (u, v) between groups of one district: "X D.C.", "D.C." and "X".

    The head X of a place bridges if one group has it; abbreviations stand for any
    district, so they join all bridging heads."""
    tokens = T.alias_tokens(F.col("name"))
    rows = mentions.where("family in ('place', 'unknown')").select("root", "family", tokens.alias("t")).where("size(t) > 0")
    short = F.array_join("t", "") == "dc"
    long = (F.size("t") > 2) & (F.element_at("t", -1) == "c") & (F.get("t", F.size("t") - 2) == "d")
    heads = rows.where(~short & long & (F.size("t") == 3) & (F.col("family") == "place")).groupBy(F.col("t")[0].alias("head")).agg(F.min("root").alias("anchor"), F.count_distinct("root").alias("n")).where("n = 1")
    alone = rows.where(~short & (F.size("t") == 1)).select(F.col("t")[0].alias("head"), "root").distinct()
    districts = rows.where(short | long).select(F.lit("dc").alias("district"), "root").distinct()
    hub = heads.groupBy(F.lit("dc").alias("district")).agg(F.min("anchor").alias("hub"))
    joined = heads.withColumn("district", F.lit("dc")).join(hub, "district").join(districts.select("district").distinct(), "district", "left_semi")
    out = _edges(alone.join(heads, "head"), "root", "anchor").union(_edges(joined, "anchor", "hub")).union(_edges(districts.join(hub, "district"), "root", "hub"))
    return out.distinct()


def descriptor_edges(mentions: DataFrame) -> DataFrame:
    """Edges (u, v) from the one organization group called "the <head>" to the one whose
    text speaks of that head."""
    own = mentions.where("family = 'organization'")
    surface = own.select(T.descriptor_head(F.col("name")).alias("head"), "root").where("head is not null")
    context = own.select(F.explode(T.descriptor_heads_in(F.coalesce("context", F.lit("")))).alias("head"), "root")

    def only(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("head").agg(F.min("root").alias(name), F.count_distinct("root").alias("n")).where("n = 1").select("head", name)

    return _edges(only(surface, "s").join(only(context, "c"), "head"), "s", "c")


def collapsed(mentions: DataFrame) -> DataFrame:
    """(entity_id, root) after all bridges: groups with a common signature first, then
    what persons, places and descriptions add between those."""

    def renamed(rows: DataFrame, edges: DataFrame) -> DataFrame:
        found = components(edges).select(F.col("id").alias("root"), "component")
        return rows.join(found, "root", "left").withColumn("root", F.coalesce("component", "root")).drop("component")

    merged = renamed(mentions, signature_edges(mentions))
    edges = person_edges(merged).union(place_edges(merged)).union(descriptor_edges(merged))
    return renamed(merged, edges).select("entity_id", "root")


def split_persons(clustered: DataFrame) -> DataFrame:
    """(cluster, entity_id, part) of proposed clusters (cluster, entity_id, name, family,
    ord): person clusters fall apart by surname, and a surname with several given names
    by those. An initial goes to the one given name it fits, else it stands alone, as a
    bare surname does there. The first member by ord decides the family."""
    kind = clustered.groupBy("cluster").agg(F.min_by("family", F.struct("ord", "entity_id")).alias("kind"))
    rows = clustered.join(kind, "cluster").withColumn("p", T.person_name(F.col("name"))).withColumn("surname", F.coalesce("p.surname", "entity_id"))
    people = rows.where("kind = 'person'").select("cluster", "entity_id", "surname", F.col("p.given").alias("given"), F.col("p.initial").alias("initial"))
    many = people.groupBy("cluster", "surname").agg(F.count_distinct("given").alias("n"))
    fits = people.where("given is not null").groupBy("cluster", "surname", "initial").agg(F.min("given").alias("fit"), F.count_distinct("given").alias("m"))
    joined = people.join(many, ["cluster", "surname"]).join(fits, ["cluster", "surname", "initial"], "left")
    given = F.coalesce("given", F.when(F.col("m") == 1, F.col("fit")))
    part = F.when(F.col("n") <= 1, F.concat_ws("|", "cluster", "surname")).when(given.isNotNull(), F.concat_ws("|", "cluster", "surname", given)).otherwise(F.concat_ws("|", "cluster", "entity_id"))
    others = rows.where("kind <> 'person' or kind is null").select("cluster", "entity_id", F.col("cluster").alias("part"))
    return joined.select("cluster", "entity_id", part.alias("part")).unionByName(others)
