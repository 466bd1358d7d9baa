"""Dump tables kept in buckets of one key, so that work by this key needs no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder


def write_bucketed(df: DataFrame, name: str, by: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as the table ``name`` in ``buckets`` files by the hash of ``by``, sorted inside; read it back.

    Tables written with the same key type and number of buckets join, group and rank by that key (and more) without
    an exchange. The rows are shuffled once, here. All rows of one key are in one file: choose as many buckets as
    files of a fair size need, and leave a key that holds much of the table to the unbucketed form,
    which adaptive execution can split. ``path``: folder of the files, else the warehouse's.
    """
    spark = df.sparkSession
    writer = df.repartition(buckets, by).write.format("parquet").bucketBy(buckets, by).sortBy(by)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def bucketed_dump(spark: SparkSession, tables: Mapping[str, DataFrame], by: str | Mapping[str, str], buckets: int, folder: str | None = None) -> dict[str, DataFrame]:
    """Tables of a dump in buckets of their person's key (``by``: one column name, or one a table), under names of this call.

    The files go to the shared folder unless another is named.
    """
    call = uuid.uuid4().hex[:12]
    folder = folder or f"{shared_folder(spark)}/buckets-{call}"
    key = lambda name: by if isinstance(by, str) else by[name]
    return {name: write_bucketed(df, f"{name}_{call}", key(name), buckets, f"{folder}/{name}") for name, df in tables.items()}
