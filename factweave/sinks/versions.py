"""Tables that are rewritten in versions: readers see one version whole, and a retry adds
nothing.

Rows lie in buckets of their key. A rewrite writes the buckets it touches into a folder of
its own and then a manifest, which says for each bucket the folder it is read from; a
version is there when its manifest is complete. Old folders stay, so a reader that began
before goes on reading what it began with. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 32


class Versions:
    """A versioned table at ``path`` with rows keyed by ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def _listed(self, folder: str) -> list[tuple[str, bool]]:
        """Names in a folder, and whether each holds what a finished write leaves."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        home = jvm.org.apache.hadoop.fs.Path(folder)
        files = home.getFileSystem(conf)
        if not files.exists(home):
            return []
        return [(s.getPath().getName(), files.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))) for s in files.listStatus(home)]

    def _manifests(self) -> dict[int, str]:
        """Complete manifests by version."""
        return {int(name.removeprefix("v")): f"{self.path}/manifests/{name}" for name, whole in self._listed(f"{self.path}/manifests") if whole}

    def current(self) -> int:
        """The newest version, 0 where there is none."""
        return max(self._manifests(), default=0)

    def _manifest(self, version: int) -> list:
        """(bucket, folder, change) of a version: a row for each bucket."""
        return self.spark.read.parquet(self._manifests()[version]).collect() if version else []

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, the newest if none is named. A version that is not there
        raises."""
        version = self.current() if version is None else version
        if not version or version not in self._manifests():
            raise LookupError(f"no version {version} of {self.path}")
        folders = sorted({f"{r['folder']}/bucket={r['bucket']}" for r in self._manifest(version) if r["folder"]})
        schema = self.spark.read.parquet(f"{self.path}/shape").schema
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _publish(self, rows: DataFrame, version: int, touched: list[int], change: str) -> int:
        folder = f"{self.path}/data/v{version}"
        # A folder without a manifest is what a failed try left: its buckets are written over.
        rows.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        written = {int(name.removeprefix("bucket=")) for name, _ in self._listed(folder) if name.startswith("bucket=")}
        held = {r["bucket"]: r["folder"] for r in self._manifest(version - 1)} if version > 1 else {}
        held |= {b: folder if b in written else None for b in touched}
        manifest = [(b, held.get(b), change) for b in range(self.buckets)]
        self.spark.createDataFrame(manifest, "bucket int, folder string, change string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/v{version}")
        return version

    def create(self, rows: DataFrame) -> int:
        """The first version. Where there is one, nothing is done."""
        if self.current():
            return self.current()
        rows.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/shape")
        return self._publish(rows, 1, list(range(self.buckets)), "create")

    def rewrite(self, changes: DataFrame, change: str) -> int:
        """A version in which the rows of each key in ``changes`` are those of ``changes``.

        ``change`` names the rewrite: the newest version's own is not applied again, so a
        retry is harmless. A key that the table does not hold raises, a null one too. Only
        buckets with a changed key are read and written."""
        version = self.current()
        if version and self._manifest(version)[0]["change"] == change:
            return version
        now = self.read(version)
        keyed = changes.select(now.columns).withColumn("_bucket", self._bucket())
        # As many rows as there are buckets.
        touched = sorted(r[0] for r in keyed.select("_bucket").distinct().collect())
        if not touched:
            return version
        own = now.withColumn("_bucket", self._bucket()).where(F.col("_bucket").isin(*touched))
        missing = keyed.join(own, self.key, "left_anti").select(self.key).first()
        if missing is not None:
            raise LookupError(f"not in the table: {missing[0]}")
        kept = own.join(keyed.select(self.key).distinct(), self.key, "left_anti")
        return self._publish(kept.unionByName(keyed).drop("_bucket"), version + 1, touched, change)
