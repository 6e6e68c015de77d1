"""Lineage cuts that survive lost executors: tables in the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one where the
    setting is absent, on a local master alone."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="factweave-")
    return _OWN[app]


def written(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back. The table is
    removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/factweave/{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch at most where rows hold whole texts.
TEXT_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session held to TEXT_ROWS rows an Arrow batch (a lower setting
    stays): Spark bounds batches by rows alone, and texts may be long."""
    spark = df.sparkSession
    if not 0 < int(spark.conf.get(_BATCH, "10000")) <= TEXT_ROWS:
        spark.conf.set(_BATCH, str(TEXT_ROWS))
    return df


def forget(df: DataFrame) -> None:
    """Remove a table that ``written`` made and no later plan reads."""
    for path in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        for entry in [e for e in _WRITTEN if e[1].rsplit("/", 1)[-1] == path.rsplit("/", 1)[-1]]:
            _WRITTEN.remove(entry)
            _delete(*entry)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def _clean() -> None:
    for spark, path in _WRITTEN:
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            _delete(spark, path)


atexit.register(_clean)
