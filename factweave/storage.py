"""Tables that cut the lineage of iterations, in the folder that spark.checkpoint.dir names."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster. A local master without one gets a temporary
    folder; any other raises, since executors share no local disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="factweave-graph-")
    return _OWN[context.applicationId]


def write(df: DataFrame) -> str:
    """Path of ``df`` as a Parquet table, which is removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/graph/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which is removed when the driver ends."""
    path = f"{shared_folder(spark)}/graph/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df`` read back from such a table: its own size then stands in for the plan's
    estimates, which grow with every round of an iteration."""
    return df.sparkSession.read.schema(df.schema).parquet(write(df))


def apart(df: DataFrame) -> DataFrame:
    """``df`` to be joined by shuffle and sort. Spark broadcasts what it takes for small, and
    goes by compressed files, as they are before an explode; what grows with the input
    must not be sized so. Measured sizes do not undo it."""
    return df.hint("merge")


def drop(*frames: DataFrame) -> None:
    """Remove tables that ``cut`` made and no later plan reads."""
    names = {f.rsplit("/", 2)[-2] for df in frames for f in df.inputFiles()}
    for entry in [e for e in _WRITTEN if e[1].rsplit("/", 1)[-1] in names]:
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
