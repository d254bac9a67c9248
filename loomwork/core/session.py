"""Session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution picks partition counts, join sides and skew splits at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(app: str = "loomwork", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in {**DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
