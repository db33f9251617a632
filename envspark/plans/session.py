"""Session settings that the plans of this library profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot leaves methods above 8000 bytes of bytecode to the interpreter. Wide
# projections fused into one stage pass that, so stages whose generated method
# would be too large run operator by operator with compiled projections instead.
HUGE_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
JIT_METHOD_LIMIT = 8000


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that may change at run time; cluster sizing is left alone."""
    if int(spark.conf.get(HUGE_METHOD_LIMIT)) > JIT_METHOD_LIMIT:
        spark.conf.set(HUGE_METHOD_LIMIT, str(JIT_METHOD_LIMIT))
    return spark
