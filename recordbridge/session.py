"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the plans count on. A join partition holding a hot key is split by
# adaptive execution, also when that costs a further exchange behind the join.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the options this library relies on; sizes stay with the cluster."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder of this application that every executor can reach, for intermediate tables.

    It lies in ``spark.checkpoint.dir``, else in the warehouse, and can be deleted when the
    application has ended.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
    return f"{folder.rstrip('/')}/recordbridge-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    What is read back stays the same however often it is scanned and whichever
    executors are lost, which a recomputed range partitioning would not.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
