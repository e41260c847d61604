"""A session with the settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "weftmatch", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive plans with skew splitting, Arrow transfer; the master and sizes come from the cluster if not given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for key, value in {**base, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
