"""Validation of assertion payloads against a profile, as one set of findings.

A payload is three tables: payloads (payload_id, predicate), roles (payload_id, role_id,
n) and fillers (payload_id, role_id, idx, kind, entity_id, entity_type, value_kind). A
profile is small tables: allowed (predicate), rules (predicate), role_rules (predicate,
role_id, allowed, required, min_count, max_count), types (predicate, role_id,
expected_type) and kinds (predicate, role_id, expected_kind). Checks of payloads, of roles, of roles that are
not there and of fillers are a table each: its rows meet all rules they need once and
give an array of findings.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.storage import apart

# Codes of findings and their default severity.
SEVERITY = {
    "oc:hard_missing_predicate": "hard",
    "oc:hard_missing_roles": "hard",
    "oc:hard_missing_role_fillers": "hard",
    "oc:hard_missing_entity_id": "hard",
    "oc:soft_noncanonical_entity_id": "soft",
    "oc:profile_unknown_predicate": "hard",
    "oc:profile_disallowed_role": "hard",
    "oc:profile_missing_required_role": "hard",
    "oc:profile_role_cardinality_violation": "soft",
    "oc:profile_missing_entity_type": "hard",
    "oc:profile_role_type_violation": "hard",
    "oc:profile_role_type_unknown_relationship": "soft",
    "oc:profile_role_value_kind_violation": "hard",
    "oc:profile_missing_value_kind": "hard",
}


@dataclass(frozen=True)
class Profile:
    allowed: DataFrame
    rules: DataFrame
    role_rules: DataFrame
    types: DataFrame
    kinds: DataFrame
    closure: DataFrame  # (child, ancestor)
    mode: str = "closed"  # open, closed or mixed
    type_check: str = "hierarchical"  # skip, exact or hierarchical


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def _check(holds: Column, code: str | Column, path: Column) -> Column:
    """A finding where ``holds``, else null."""
    return F.when(F.coalesce(holds, F.lit(False)), F.struct((F.lit(code) if isinstance(code, str) else code).alias("code"), path.alias("path")))


def _found(rows: DataFrame, *checks: Column) -> DataFrame:
    return rows.select("payload_id", F.explode(F.filter(F.array(*checks), lambda f: f.isNotNull())).alias("f")).select("payload_id", "f.code", "f.path")


def _mark(rows: DataFrame, name: str) -> DataFrame:
    return rows.distinct().withColumn(name, F.lit(True))


def findings(payloads: DataFrame, roles: DataFrame, fillers: DataFrame, profile: Profile) -> DataFrame:
    """(payload_id, code, path, severity) of every finding."""
    role_path = F.concat(F.lit("roles."), F.col("role_id"))
    filler_path = F.concat(role_path, F.lit("["), F.col("idx").cast("string"), F.lit("]"))
    has = lambda name: F.coalesce(F.col(name), F.lit(False))
    allowed = _mark(profile.allowed.select("predicate"), "known")
    named = payloads.select("payload_id", F.when(~_blank(F.col("predicate")), F.trim("predicate")).alias("predicate")).join(allowed, "predicate", "left")

    heads = named.join(apart(_mark(roles.select("payload_id"), "with_roles")), "payload_id", "left")
    unknown = F.col("predicate").isNotNull() & has("with_roles") & ~has("known") & F.lit(profile.mode != "open")
    of_payloads = _found(
        heads,
        _check(F.col("predicate").isNull(), "oc:hard_missing_predicate", F.lit("predicate")),
        _check(~has("with_roles"), "oc:hard_missing_roles", F.lit("roles")),
        _check(unknown, "oc:profile_unknown_predicate", F.lit("predicate")),
    )
    ruled = _mark(profile.role_rules.where("allowed").select("predicate"), "ruled")
    own = roles.join(apart(named), "payload_id", "left").join(ruled, "predicate", "left").join(profile.role_rules, ["predicate", "role_id"], "left")
    off = has("known") & ((F.col("n") < F.col("min_count")) | (F.col("n") > F.col("max_count")))
    of_roles = _found(
        own,
        _check(F.col("n") == 0, "oc:hard_missing_role_fillers", role_path),
        _check(has("known") & has("ruled") & ~has("allowed"), "oc:profile_disallowed_role", role_path),
        _check(has("known") & has("required") & (F.col("n") == 0), "oc:profile_missing_required_role", role_path),
        _check(off, "oc:profile_role_cardinality_violation", role_path),
    )
    asked = profile.role_rules.where("required or min_count > 0")
    absent = heads.where("known and with_roles").join(asked, "predicate").join(apart(roles.select("payload_id", "role_id")), ["payload_id", "role_id"], "left_anti")
    of_absent = _found(
        absent,
        _check(F.col("required"), "oc:profile_missing_required_role", role_path),
        _check(F.col("min_count") > 0, "oc:profile_role_cardinality_violation", role_path),
    )

    rows = fillers.join(apart(named.select("payload_id", "predicate")), "payload_id", "left").join(profile.types, ["predicate", "role_id"], "left").join(profile.kinds, ["predicate", "role_id"], "left")
    is_value = F.coalesce(F.col("kind") == "value", F.lit(False))
    no_id, no_type, no_kind = _blank(F.col("entity_id")), _blank(F.col("entity_type")), _blank(F.col("value_kind"))
    typed, valued = F.col("expected_type").isNotNull() & ~is_value, F.col("expected_kind").isNotNull()
    wrong = typed & ~no_type & (F.col("entity_type") != F.col("expected_type"))
    violation: str | Column = "oc:profile_role_type_violation"
    if profile.type_check == "skip":
        wrong = F.lit(False)
    elif profile.type_check == "hierarchical":
        below = _mark(profile.closure.select(F.col("child").alias("entity_type"), F.col("ancestor").alias("expected_type")), "below")
        types = profile.closure.select(F.col("child").alias("t")).union(profile.closure.select("ancestor")).union(profile.types.select("expected_type")).distinct()
        rows = rows.join(below, ["entity_type", "expected_type"], "left")
        for column in ("entity_type", "expected_type"):
            rows = rows.join(_mark(types.select(F.col("t").alias(column)), f"{column}_known"), column, "left")
        wrong = wrong & ~has("below")
        violation = F.when(has("entity_type_known") | has("expected_type_known"), violation).otherwise("oc:profile_role_type_unknown_relationship")
    at = lambda name: F.concat(filler_path, F.lit(f".{name}"))
    of_fillers = _found(
        rows,
        _check(~is_value & no_id, "oc:hard_missing_entity_id", at("entity_id")),
        _check(~is_value & ~no_id & ~F.col("entity_id").startswith("ent:"), "oc:soft_noncanonical_entity_id", at("entity_id")),
        _check(typed & no_type, "oc:profile_missing_entity_type", at("entity_type")),
        _check(wrong, violation, at("entity_type")),
        _check(valued & ~is_value, "oc:profile_role_value_kind_violation", at("kind")),
        _check(valued & is_value & no_kind, "oc:profile_missing_value_kind", at("value_kind")),
        _check(valued & is_value & ~no_kind & (F.col("value_kind") != F.col("expected_kind")), "oc:profile_role_value_kind_violation", at("value_kind")),
    )
    out = [of_payloads, of_roles, of_absent, of_fillers]
    every = reduce(DataFrame.unionByName, out)
    table = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    soft_unknown = (F.col("code") == "oc:profile_unknown_predicate") & F.lit(profile.mode == "mixed")
    return every.withColumn("severity", F.when(soft_unknown, "soft").otherwise(table[F.col("code")]))


def outcomes(payloads: DataFrame, found: DataFrame) -> DataFrame:
    """(payload_id, status, codes) with findings in order of code and path."""
    by = found.groupBy("payload_id").agg(F.count_if(F.col("severity") == "hard").alias("hard"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("code", "path"))), lambda s: s["code"]), ",").alias("codes"))
    status = F.when(F.col("hard") > 0, "invalid").when(F.col("hard").isNotNull(), "needs_review").otherwise("valid")
    return payloads.select("payload_id").join(apart(by), "payload_id", "left").select("payload_id", status.alias("status"), F.coalesce("codes", F.lit("")).alias("codes"))


def alias_collisions(aliases: DataFrame) -> DataFrame:
    """(alias, canonicals) of aliases that stand for several canonical ids."""
    return aliases.groupBy(F.lower(F.trim("alias")).alias("alias")).agg(F.count_distinct("canonical_id").alias("canonicals")).where("canonicals > 1")


# Rules between a profile's mode, its proposal policy and its severities.
POLICY_RULES = {
    "open_rejects_proposals": "mode = 'open' and proposal_policy <> 'reject'",
    "allowlist_needed": "mode in ('closed', 'mixed') and n_allowed = 0",
    "closed_unknown_is_hard": "mode = 'closed' and not severity <=> 'hard'",
    "mixed_unknown_is_soft": "mode = 'mixed' and not severity <=> 'soft'",
    "type_adapter_needs_pack": "type_adapter = 'ontology_pack' and pack is null",
    "mixed_allows_proposals": "mode = 'mixed' and proposal_policy <> 'allow'",
    "propose_needs_allow": "array_contains(actions, 'propose') and proposal_policy <> 'allow'",
    "overlay_needs_allow": "overlay_target is not null and proposal_policy <> 'allow'",
}


def policy_violations(profiles: DataFrame) -> DataFrame:
    """``profiles`` (mode, proposal_policy, severity of an unknown predicate, n_allowed,
    type_adapter, pack, overlay_target, actions) with ``violations``, the names of the
    rules that a profile breaks; one that breaks any must not be loaded."""
    marks = [F.when(F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in POLICY_RULES.items()]
    return profiles.withColumn("violations", F.filter(F.array(*marks), lambda x: x.isNotNull()))


def overlay_target(pack: Column, proposal_policy: Column, suffix: str = "__overlay") -> Column:
    """Pack that proposals go to: the base pack's overlay, where proposals are allowed."""
    return F.when(proposal_policy == "allow", F.concat(pack, F.lit(suffix)))


def overlay_path(root: str, overlay: Column, version: Column, file: str) -> Column:
    """Where an overlay pack's additions are appended."""
    return F.concat_ws("/", F.lit(root.rstrip("/")), overlay, version, F.lit(file))


def profile_rules(pack_rules: DataFrame, own_rules: DataFrame, pack_predicates: DataFrame, allowed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(role rules, allowed predicates) of a profile: its own rules replace the pack's for
    each predicate they speak of; an empty allow-list means all of the pack's predicates."""
    own = own_rules.select("predicate").distinct()
    rules = pack_rules.join(own, "predicate", "left_anti").unionByName(own_rules)
    listed = allowed.select("predicate").distinct()
    some = listed.agg(F.count("*").alias("n"))
    # One row with the size of the list decides for all predicates.
    either = pack_predicates.select("predicate").distinct().withColumn("one", F.lit(1)).join(some.withColumn("one", F.lit(1)), "one").where("n = 0").select("predicate")
    return rules, listed.union(either)


def ordered(found: DataFrame) -> DataFrame:
    """Findings with ``place``, counting those of a payload in order of code and path."""
    return found.withColumn("place", F.row_number().over(Window.partitionBy("payload_id").orderBy("code", "path")))


def loosened(constraints: DataFrame, keep: DataFrame, role: str = "agent", narrow: str = "Human", wide: str = "CognitiveAgent") -> DataFrame:
    """``constraints`` (predicate, sense, abstract_role, type_constraint) with ``before`` and
    ``changed``: of a role's constraints those that are ``narrow`` become ``wide``, but for
    the senses in ``keep`` (sense). What changed can be counted first, as a dry run."""
    kept = keep.select("sense").where("sense is not null").distinct().withColumn("_kept", F.lit(True))
    rows = constraints.join(kept, "sense", "left")
    changed = F.coalesce((F.col("abstract_role") == role) & (F.col("type_constraint") == narrow), F.lit(False)) & F.col("_kept").isNull()
    return rows.withColumns({"before": F.col("type_constraint"), "changed": changed, "type_constraint": F.when(changed, wide).otherwise(F.col("type_constraint"))}).select(*constraints.columns, "before", "changed")
