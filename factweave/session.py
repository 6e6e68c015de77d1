"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "factweave", **settings: str) -> SparkSession:
    """A session with adaptive execution, ANSI arithmetic and UTC. Further settings come
    from the cluster or from ``settings`` (dots written as two underscores)."""
    builder = SparkSession.builder.appName(app)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for key, value in (fixed | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
