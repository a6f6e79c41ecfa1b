"""Session settings the jobs rely on; everything else is left to Spark's defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: Bytes of a method up to which the JVM compiles it; a longer one is interpreted for good.
COMPILED_BYTES = "8000"


def compiled(spark: SparkSession) -> None:
    """Chains of expressions that would become one method too long for the JVM's compiler run operator by operator, in methods that it compiles."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_BYTES)


def session(app_name: str = "factloom", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
