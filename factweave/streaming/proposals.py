"""A sink for proposals that a stream delivers: each is recorded once, whatever is replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from factweave.functions.text import short_digest

COLUMNS = ("proposal_id", "kind", "value", "profile", "first_batch")


def proposal_id(kind, value, profile):
    """Stable id of what is proposed, whoever proposes it."""
    return F.concat(F.lit("prop_"), short_digest(F.concat_ws("|", kind, F.lower(F.trim(value)), profile), 24))


class ProposalSink:
    """Proposals under ``path``, a folder for each batch.

    A batch writes what no earlier batch has recorded into its own folder, over what a
    failed or repeated try left there, and then its line of the ledger. So a batch that is
    replayed, by a restart or by hand, gives the same rows again, and none twice."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, requests: DataFrame, batch_id: int) -> None:
        """Record one batch of requests (kind, value, profile); of several for one item one
        row stays. Requests without a kind or a value are left out."""
        spark = requests.sparkSession
        named = requests.where(F.col("kind").isNotNull() & (F.trim(F.coalesce("value", F.lit(""))) != ""))
        rows = named.withColumn("proposal_id", proposal_id(F.col("kind"), F.col("value"), F.coalesce("profile", F.lit("")))).groupBy("proposal_id").agg(F.min(F.struct("kind", "value", "profile")).alias("r"))
        rows = rows.select("proposal_id", "r.*", F.lit(batch_id).cast("long").alias("first_batch"))
        earlier = [b for b in self._ledger(spark) if b < batch_id]
        if earlier:
            known = spark.read.parquet(*[f"{self.path}/batches/{b}" for b in earlier]).select("proposal_id")
            rows = rows.join(known, "proposal_id", "left_anti")
        rows.select(*COLUMNS).write.mode("overwrite").parquet(f"{self.path}/batches/{batch_id}")
        spark.createDataFrame([(batch_id,)], "batch_id long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/{batch_id}")

    def _ledger(self, spark: SparkSession) -> list[int]:
        """Batches that are recorded whole."""
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        home = jvm.org.apache.hadoop.fs.Path(f"{self.path}/ledger")
        files = home.getFileSystem(conf)
        if not files.exists(home):
            return []
        return sorted(int(s.getPath().getName()) for s in files.listStatus(home) if files.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))

    def write(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        """A writer of a stream of requests; the caller sets its trigger and starts it."""
        return stream.writeStream.foreachBatch(self.record).option("checkpointLocation", checkpoint)

    def proposals(self) -> DataFrame:
        """All recorded proposals, each once."""
        done = self._ledger(self.spark)
        if not done:
            return self.spark.createDataFrame([], "proposal_id string, kind string, value string, profile string, first_batch long")
        return self.spark.read.parquet(*[f"{self.path}/batches/{b}" for b in done])
