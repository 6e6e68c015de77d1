"""The assertion model over the star-schema tables: candidates, promoted assertions, role
fillers, entities, identities, a type hierarchy, dispositions and lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.storage import apart

ROLE_LABELS = {"part": "ARG0", "supplier": "ARG1"}


class Tables:
    """Model tables of one data folder, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def candidates(self) -> DataFrame:
        orders, customer = self.raw("orders"), self.raw("customer")
        status = F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O", "pending_review").otherwise("rejected")
        validation = F.when(F.col("o_totalprice") < 50_000, "needs_review").when(F.col("o_totalprice") < 100_000, "invalid").otherwise("valid")
        return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
            F.concat(F.lit("cand_"), F.col("o_orderkey")).alias("candidate_id"),
            F.col("o_orderpriority").alias("predicate"),
            status.alias("review_status"),
            validation.alias("validation_status"),
            F.col("c_mktsegment").alias("source_ref"),
            F.col("o_orderdate").alias("submitted_at"),
            F.col("o_totalprice").alias("weight"),
            "o_orderkey", "o_custkey",
        )

    def reviews(self) -> DataFrame:
        c = self.candidates().where("review_status <> 'pending_review'")
        return c.select("candidate_id", F.col("review_status").alias("decision"), F.concat(F.lit("actor_"), F.col("o_custkey") % 7).alias("actor_id"))

    def assertions(self) -> DataFrame:
        c = self.candidates().where("review_status = 'accepted'")
        return c.select(F.concat(F.lit("gassert_"), T.short_digest("candidate_id")).alias("assertion_id"), "candidate_id", "predicate", "source_ref", F.col("submitted_at").alias("promoted_at"), "weight", "o_orderkey", "o_custkey")

    def fillers(self) -> DataFrame:
        """One row for each entity filler: role, index in the role, entity."""
        order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
        items = self.raw("lineitem").withColumn("filler_index", (F.row_number().over(order) - 1).cast("long"))
        both = F.array(F.struct(F.lit("part").alias("role_id"), F.concat(F.lit("part_"), F.col("l_partkey")).alias("entity_id")), F.struct(F.lit("supplier").alias("role_id"), F.concat(F.lit("supp_"), F.col("l_suppkey")).alias("entity_id")))
        rows = items.select("l_orderkey", "filler_index", "l_quantity", F.explode(both).alias("f")).select("l_orderkey", "filler_index", "l_quantity", "f.*")
        keys = self.assertions().select("assertion_id", "promoted_at", "predicate", "o_orderkey")
        return apart(rows).join(keys, F.col("l_orderkey") == F.col("o_orderkey")).select("assertion_id", "promoted_at", "predicate", "role_id", "filler_index", "entity_id", "l_quantity")

    def entities(self) -> DataFrame:
        part = self.raw("part").select(F.concat(F.lit("part_"), F.col("p_partkey")).alias("entity_id"), F.col("p_type").alias("entity_type"), F.col("p_name").alias("name"), F.col("p_partkey").alias("ord"))
        supplier = self.raw("supplier").select(F.concat(F.lit("supp_"), F.col("s_suppkey")).alias("entity_id"), F.lit("oc:organization").alias("entity_type"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("ord"))
        return part.union(supplier)

    def memberships(self) -> DataFrame:
        """Identity of each part: parts that share a name; the first is canonical."""
        parts = self.entities().where("entity_id like 'part%'")
        first = parts.groupBy("name").agg(F.min("ord").alias("first"))
        kind = F.when(F.col("ord") == F.col("first"), "canonical").otherwise("alias")
        return parts.join(first, "name").select(F.concat(F.lit("gident_"), T.short_digest("name")).alias("identity_id"), "entity_id", kind.alias("membership_kind"), F.col("name").alias("display_label"), "ord")

    def references(self) -> DataFrame:
        """External references of identities, one for every third member."""
        m = self.memberships().where("ord % 3 = 0")
        status = F.when(F.col("ord") % 2 == 0, "attached").otherwise("unresolved")
        provider = F.when(F.col("ord") % 5 == 0, "wikidata").otherwise("registry")
        return m.select("identity_id", provider.alias("provider"), status.alias("reference_status"), F.when(F.col("ord") % 2 == 0, F.concat(F.lit("Q"), F.col("ord"))).alias("external_id"), "ord")

    def type_edges(self) -> DataFrame:
        part = self.raw("part").select(F.col("p_type").alias("child"), F.col("p_brand").alias("parent")).distinct()
        top = self.raw("part").select(F.col("p_brand").alias("child"), F.lit("part").alias("parent")).distinct()
        nation = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
        region = self.raw("region").select(F.col("r_name").alias("child"), F.lit("world").alias("parent"))
        return part.union(top).union(nation).union(region)

    def confidences(self) -> DataFrame:
        """Score of every second accepted candidate."""
        return self.assertions().where("o_orderkey % 2 = 0").select("candidate_id", (F.col("o_orderkey") % 101 / 100.0).alias("confidence_score"))

    def supersessions(self) -> DataFrame:
        """Every tenth accepted candidate is replaced by the next one of its customer."""
        order = Window.partitionBy("o_custkey").orderBy("o_orderkey")
        a = self.assertions().withColumn("replacement_candidate_id", F.lead("candidate_id").over(order))
        return a.where("o_orderkey % 10 = 0 and replacement_candidate_id is not null").select(F.col("candidate_id").alias("prior_candidate_id"), "replacement_candidate_id", F.col("promoted_at").alias("created_at"))

    def dispositions(self) -> DataFrame:
        """Events on assertions as changes of status."""
        target = F.when(F.col("event_type") == "error", "retracted").when(F.col("event_type") == "click", "weakened").when(F.col("event_type") == "view", "active")
        a = self.assertions().select("assertion_id", "o_orderkey")
        e = self.raw("events").withColumn("target_status", target).where("target_status is not null").withColumn("k", F.col("event_id"))
        return e.join(a, F.col("k") == F.col("o_orderkey")).select("assertion_id", "event_id", F.col("ts").alias("created_at"), "target_status")

    def lineage(self) -> DataFrame:
        """Artifact edges: a turn derives from the one before."""
        c = self.raw("conversations").select("conv_id", "turn").distinct()
        name = lambda t: F.concat_ws("_", F.lit("art"), F.col("conv_id"), t)
        return c.where("turn > 0").select(name(F.col("turn") - 1).alias("parent"), name(F.col("turn")).alias("child"))


#: The same views as common table expressions.
SQL = """
cand AS (SELECT 'cand_' || o_orderkey AS candidate_id, o_orderpriority AS predicate,
  CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'pending_review' ELSE 'rejected' END AS review_status,
  CASE WHEN o_totalprice < 50000 THEN 'needs_review' WHEN o_totalprice < 100000 THEN 'invalid' ELSE 'valid' END AS validation_status,
  c_mktsegment AS source_ref, o_orderdate AS submitted_at, o_totalprice AS weight, o_orderkey, o_custkey
  FROM orders JOIN customer ON o_custkey = c_custkey),
rev AS (SELECT candidate_id, review_status AS decision, 'actor_' || (o_custkey % 7) AS actor_id FROM cand WHERE review_status <> 'pending_review'),
asr AS (SELECT 'gassert_' || substr(sha256(candidate_id), 1, 24) AS assertion_id, candidate_id, predicate, source_ref, submitted_at AS promoted_at, weight, o_orderkey, o_custkey
  FROM cand WHERE review_status = 'accepted'),
items AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS filler_index FROM lineitem),
fil AS (SELECT assertion_id, promoted_at, predicate, role_id, filler_index, entity_id, l_quantity FROM (
    SELECT l_orderkey, filler_index, l_quantity, 'part' AS role_id, 'part_' || l_partkey AS entity_id FROM items
    UNION ALL SELECT l_orderkey, filler_index, l_quantity, 'supplier', 'supp_' || l_suppkey FROM items) f
  JOIN asr ON l_orderkey = o_orderkey),
ent AS (SELECT 'part_' || p_partkey AS entity_id, p_type AS entity_type, p_name AS name, p_partkey AS ord FROM part
  UNION ALL SELECT 'supp_' || s_suppkey, 'oc:organization', s_name, s_suppkey FROM supplier),
mem AS (SELECT 'gident_' || substr(sha256(name), 1, 24) AS identity_id, entity_id,
  CASE WHEN row_number() OVER (PARTITION BY name ORDER BY ord) = 1 THEN 'canonical' ELSE 'alias' END AS membership_kind, name AS display_label, ord
  FROM ent WHERE entity_id LIKE 'part%'),
ref AS (SELECT identity_id, CASE WHEN ord % 5 = 0 THEN 'wikidata' ELSE 'registry' END AS provider,
  CASE WHEN ord % 2 = 0 THEN 'attached' ELSE 'unresolved' END AS reference_status, CASE WHEN ord % 2 = 0 THEN 'Q' || ord END AS external_id, ord FROM mem WHERE ord % 3 = 0),
edge AS (SELECT DISTINCT p_type AS child, p_brand AS parent FROM part UNION ALL SELECT DISTINCT p_brand, 'part' FROM part
  UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'world' FROM region),
conf AS (SELECT candidate_id, (o_orderkey % 101) / 100.0::DOUBLE AS confidence_score FROM asr WHERE o_orderkey % 2 = 0),
sup AS (SELECT candidate_id AS prior_candidate_id, replacement_candidate_id, promoted_at AS created_at FROM (
  SELECT *, lead(candidate_id) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS replacement_candidate_id FROM asr)
  WHERE o_orderkey % 10 = 0 AND replacement_candidate_id IS NOT NULL),
disp AS (SELECT assertion_id, event_id, ts AS created_at, CASE event_type WHEN 'error' THEN 'retracted' WHEN 'click' THEN 'weakened' ELSE 'active' END AS target_status
  FROM events JOIN asr ON event_id = o_orderkey WHERE event_type IN ('error', 'click', 'view')),
lin AS (SELECT DISTINCT 'art_' || conv_id || '_' || (turn - 1) AS parent, 'art_' || conv_id || '_' || turn AS child FROM conversations WHERE turn > 0)
"""


def sql(body: str, recursive: str = "") -> str:
    """``body`` over the views; ``recursive`` adds recursive expressions."""
    return f"WITH {'RECURSIVE ' if recursive else ''}{SQL.strip()}{', ' + recursive if recursive else ''}\n{body.strip()}"
