"""Recanonicalisation of promoted assertions: canonical predicates and roles, with an
event for each rewrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions import text as T


def canonical_fillers(fillers: DataFrame, roles: DataFrame) -> DataFrame:
    """``fillers`` (assertion_id, role_id, filler_index, ..) under canonical roles
    (``roles``: alias, canonical). Fillers of roles that become one are numbered on in
    order of the old roles; ``role_changed`` marks those under a new name."""
    table = roles.select(T.lookup_key(F.col("alias")).alias("__key"), F.col("canonical").alias("__new"))
    named = fillers.withColumn("__key", T.lookup_key(F.col("role_id"))).join(table, "__key", "left").withColumn("__to", F.coalesce("__new", "role_id"))
    order = Window.partitionBy("assertion_id", "__to").orderBy("role_id", "filler_index")
    out = named.withColumn("filler_index", (F.row_number().over(order) - 1).cast("long")).withColumn("role_changed", F.col("__to") != F.col("role_id"))
    return out.withColumn("role_id", F.col("__to")).drop("__key", "__new", "__to")


def recanonicalised(assertions: DataFrame, fillers: DataFrame, predicates: DataFrame, roles: DataFrame, allowed: DataFrame) -> DataFrame:
    """``assertions`` (assertion_id, predicate) with ``status``, ``after_predicate`` and,
    where rewritten, ``event_id``.

    ``predicates`` and ``roles`` have (alias, canonical), ``allowed`` the predicates the
    profile knows. An assertion whose canonical predicate is not allowed, or that has no
    role, is a ``conflict`` and stays as it is; one that changes nothing is
    ``already_canonical``; the rest are ``rewritten``. The event's id is a digest of what
    changes, so a second run over rewritten assertions adds no event.
    """
    table = predicates.select(T.lookup_key(F.col("alias")).alias("key"), F.col("canonical").alias("to"))
    changed = canonical_fillers(fillers, roles).groupBy("assertion_id").agg(F.max("role_changed").alias("role_changed"), F.array_join(F.array_sort(F.collect_set("role_id")), ",").alias("roles"))
    rows = assertions.withColumn("key", T.lookup_key(F.col("predicate"))).join(table, "key", "left").withColumn("after", F.coalesce("to", "predicate"))
    known = allowed.select(F.col("predicate").alias("after"), F.lit(True).alias("known")).distinct()
    joined = rows.join(known, "after", "left").join(changed, "assertion_id", "left")
    conflict = F.col("known").isNull() | F.col("role_changed").isNull()
    same = (F.col("after") == F.col("predicate")) & ~F.col("role_changed")
    status = F.when(conflict, "conflict").when(same, "already_canonical").otherwise("rewritten")
    event = F.concat(F.lit("recan_"), T.short_digest(F.concat_ws("|", "assertion_id", "predicate", "after", "roles")))
    after = F.when(conflict, F.col("predicate")).otherwise(F.col("after"))
    return joined.select("assertion_id", "predicate", status.alias("status"), after.alias("after_predicate"), F.when(status == "rewritten", event).alias("event_id"))


def events(rewrites: DataFrame, existing: DataFrame) -> DataFrame:
    """(event_id, assertion_id, before_predicate, after_predicate) of rewrites that are
    not recorded yet."""
    new = rewrites.where("status = 'rewritten'").select("event_id", "assertion_id", F.col("predicate").alias("before_predicate"), "after_predicate")
    return new.join(existing.select("event_id"), "event_id", "left_anti")
