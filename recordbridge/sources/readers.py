"""CSV sources. Schemas are declared, never inferred from the data."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import excel_date
from .schemas import schema_of


def _csv(spark: SparkSession, line_breaks: bool = True):
    """Reader for quoted CSV. A file whose texts hold line breaks cannot be split, so
    say ``line_breaks=False`` for large files known to have none."""
    return spark.read.options(header=True, mode="PERMISSIVE", quote='"', escape='"', multiLine=line_breaks, nullValue="")


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line; no data rows are read."""
    return spark.read.options(header=True, quote='"', escape='"').csv(path).columns


def list_csv(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> dict[str, str]:
    """CSV files of a folder by table name, on any file system Spark can reach.

    With ``names`` the folder is not listed, which a remote session could not do.
    """
    if names is not None:
        return {n: f"{path.rstrip('/')}/{n}.csv" for n in names}
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    return {n[: -len(".csv")]: f"{path.rstrip('/')}/{n}" for n in names if n.endswith(".csv")}


def read_text_csv(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """All columns as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header_of(spark, path)])
    return _csv(spark, line_breaks).schema(schema).csv(path)


def read_dump_dir(spark: SparkSession, path: str, schemas: Mapping[str, T.StructType] | None = None, views: bool = True,
                  unbroken: Collection[str] = (), names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Every CSV of a folder as a named table and, if asked, a temporary view.

    Files without a declared schema come as text. Tables named in ``unbroken`` hold no
    line breaks inside texts and are read in parallel splits.
    """
    tables = {}
    for name, file in list_csv(spark, path, names).items():
        schema = (schemas or {}).get(name)
        broken = name not in unbroken
        tables[name] = _csv(spark, broken).schema(schema).csv(file) if schema else read_text_csv(spark, file, broken)
        if views:
            tables[name].createOrReplaceTempView(name)
    return tables


def read_typed_csv(spark: SparkSession, path: str, letters: str, names: Sequence[str] | None = None, line_breaks: bool = True) -> DataFrame:
    """CSV with one type letter per column; values that do not parse become null."""
    names = names or header_of(spark, path)
    return _csv(spark, line_breaks).schema(schema_of(names, letters)).csv(path)


RAW = "__row_text"  # text of a row of which something could not be read
REJECT_COLUMNS = "file string, row_text string, column string, value string, expected string"


class Checked(NamedTuple):
    """A typed table, and what of its files could not be read as declared."""

    table: DataFrame
    rejects: DataFrame


def checked_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = True) -> Checked:
    """CSV under a declared schema, beside the rejected values.

    The typed table is that of a plain read: a value that does not parse is null. Each such value is
    a row of ``rejects`` (file, row_text, column, value, expected type). A row with too few or too
    many cells is one row there, without column and value; its typed cells are those that could be placed.
    Spark notes the text of a row where anything went wrong; only those texts are taken apart again.
    """
    marked = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    read = _csv(spark, line_breaks).option("columnNameOfCorruptRecord", RAW).schema(marked).csv(path)
    texts = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields], T.StructField(RAW, T.StringType())])
    options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "nullValue": "", "columnNameOfCorruptRecord": RAW}
    # All columns are asked for: Spark would otherwise not parse, and so not reject, the unused ones.
    whole = read.select(F.col("_metadata.file_path").alias("__file"), F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]).alias("__typed"), F.col(RAW).alias("__text"))
    bad = whole.where(F.col("__text").isNotNull()).withColumn("__cells", F.from_csv("__text", _ddl(texts), options))
    misshaped = F.col(f"__cells.{RAW}").isNotNull()
    cells = [
        F.struct(F.lit(f.name).alias("column"), F.col(f"__cells.`{f.name}`").alias("value"), F.lit(f.dataType.simpleString()).alias("expected"), F.col(f"__typed.`{f.name}`").isNull().alias("lost"))
        for f in schema.fields
    ]
    shape = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"), F.lit(f"{len(schema)} cells").alias("expected"), F.lit(True).alias("lost"))
    found = F.when(misshaped, F.array(shape)).otherwise(F.filter(F.array(*cells), lambda c: c["lost"] & c["value"].isNotNull()))
    rejects = bad.select(F.col("__file").alias("file"), F.col("__text").alias("row_text"), F.explode(found).alias("__c")).select("file", "row_text", "__c.column", "__c.value", "__c.expected")
    return Checked(read.drop(RAW), rejects)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_checked_csv(spark: SparkSession, path: str, letters: str, names: Sequence[str] | None = None, line_breaks: bool = True) -> Checked:
    """``read_typed_csv`` beside its rejected values."""
    return checked_csv(spark, path, schema_of(names or header_of(spark, path), letters), line_breaks)


def read_checked_dump(spark: SparkSession, path: str, schemas: Mapping[str, T.StructType], unbroken: Collection[str] = (), names: Sequence[str] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables of a dump folder by name, and the rejected values of all files with a declared schema (``table`` says whose)."""
    tables, rejects = {}, []
    for name, file in list_csv(spark, path, names).items():
        if name in schemas:
            tables[name], rejected = checked_csv(spark, file, schemas[name], name not in unbroken)
            rejects.append(rejected.select(F.lit(name).alias("table"), "*"))
        else:
            tables[name] = read_text_csv(spark, file, name not in unbroken)
    none = spark.createDataFrame([], f"table string, {REJECT_COLUMNS}")
    return tables, reduce(DataFrame.unionByName, rejects) if rejects else none


def read_sheet_export(spark: SparkSession, path: str, schema: T.StructType | None = None, excel_dates: Sequence[str] = (), line_breaks: bool = True) -> DataFrame:
    """A spreadsheet sheet saved as CSV or Parquet; day numbers become dates."""
    if path.endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        df = _csv(spark, line_breaks).schema(schema).csv(path) if schema else read_text_csv(spark, path, line_breaks)
    return df.withColumns({c: excel_date(F.col(c)) for c in excel_dates})


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A small table written in code, with declared types.

    The rows are constants of the plan, so Spark knows how small the table is and
    broadcasts it without a hint.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
