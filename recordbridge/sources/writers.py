"""CSV sinks. Output goes to a new folder; input is never overwritten."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_time_text, parse_dt
from ..operators.groups import surrogate_id
from .readers import list_csv, literal_table, read_text_csv

DAY, TIME = "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"


def format_datetimes(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Dates and times as text in the given patterns."""
    return df.withColumns({c: F.date_format(F.col(f"`{c}`"), fmt) for c, fmt in formats.items()})


def import_form(df: DataFrame, dates: Sequence[str] = (), timestamps: Sequence[str] = ()) -> DataFrame:
    """Columns as the import wants them: day and time text, logicals as 0/1."""
    formats = {
        f.name: DAY if isinstance(f.dataType, T.DateType) else TIME
        for f in df.schema
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    }
    formats |= {c: DAY for c in dates} | {c: TIME for c in timestamps}
    out = format_datetimes(df, formats)
    flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    return out.withColumns({c: F.col(f"`{c}`").cast("int") for c in flags})


CSV_FORM = dict(header=True, nullValue="", emptyValue="", quote='"', escape='"', quoteAll=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_import_csv(df: DataFrame, path: str, dates: Sequence[str] = (), timestamps: Sequence[str] = ()) -> None:
    """Write once: nulls empty, logicals 0/1, quotes only where needed, outer blanks kept."""
    import_form(df, dates, timestamps).write.options(**CSV_FORM).csv(path)


def write_import_set(df: DataFrame, path: str, name: str, order: Sequence[str], rows_per_file: int = 100_000, unique: bool = False) -> DataFrame:
    """Import files of a stated number of rows in a stated order, and their manifest.

    The rows are numbered in a total order (``order``, ended by all other columns unless it is
    ``unique``); a file holds the next ``rows_per_file`` of them, in order. Equal tables give files
    equal byte by byte, whatever their layout. Files and ``manifest.csv`` are made in a folder of
    their own beside ``path``, which takes that name when all is written; a run that is broken off leaves no
    ``path``, and an existing one is an error. Returns the manifest: file, rows, bytes, sha256.
    """
    spark, number = df.sparkSession, F.col("__n")
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    target, working = path.rstrip("/"), f"{path.rstrip('/')}.making-{uuid.uuid4().hex}"
    fs = Path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(Path(target)):
        raise ValueError(f"{target} exists")
    filed = surrogate_id(df, order, "__n", unique=unique).withColumn("__file", F.floor((number - 1) / rows_per_file))
    sizes = dict(filed.groupBy("__file").count().collect())  # one number a file
    formed = import_form(filed.drop("__n", "__file"))
    rows = import_form(filed).select(*[f"`{c}`" for c in formed.columns], "__n", "__file")
    # A file is the rows of one task of one number; its rows are sorted there and the number is no column of it.
    placed = rows.repartition(max(len(sizes), 1), "__file").sortWithinPartitions("__file", "__n").drop("__n")
    placed.write.options(**CSV_FORM).partitionBy("__file").csv(f"{working}/parts")
    named = []
    for i in sorted(sizes):
        (part,) = [s.getPath() for s in fs.listStatus(Path(f"{working}/parts/__file={i}")) if s.getPath().getName().startswith("part-")]
        named.append(f"{name}-{i + 1:05d}.csv")
        if not fs.rename(part, Path(f"{working}/{named[-1]}")):
            raise OSError(f"{part} could not be renamed")
    fs.delete(Path(f"{working}/parts"), True)
    # Files of stated size: their bytes are read by the executors, one file at a time.
    if named:
        content = spark.read.format("binaryFile").load([f"{working}/{n}" for n in named])
        sums = {r.file: (r.bytes, r.sha256) for r in content.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).collect()}
    lines = [(n, sizes[i], *sums[n]) for i, n in zip(sorted(sizes), named)]
    manifest = literal_table(spark, lines, MANIFEST) if lines else spark.createDataFrame([], MANIFEST)
    manifest.coalesce(1).write.options(**CSV_FORM).csv(f"{working}/manifest")
    (part,) = [s.getPath() for s in fs.listStatus(Path(f"{working}/manifest")) if s.getPath().getName().startswith("part-")]
    fs.rename(part, Path(f"{working}/manifest.csv"))
    fs.delete(Path(f"{working}/manifest"), True)
    if not fs.rename(Path(working), Path(target)):
        raise OSError(f"{working} could not be renamed")
    return manifest


def broken_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of an import set that are missing or not as its manifest says: (file, problem)."""
    said = spark.read.options(header=True).schema(MANIFEST).csv(f"{path.rstrip('/')}/manifest.csv")
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*-[0-9]*.csv").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("__bytes"), F.sha2("content", 256).alias("__sha256"),
    )
    both = said.join(there, "file", "full")
    problem = F.when(F.col("__bytes").isNull(), "missing").when(F.col("bytes").isNull(), "not in the manifest").when((F.col("bytes") != F.col("__bytes")) | (F.col("sha256") != F.col("__sha256")), "changed")
    return both.select("file", problem.alias("problem")).where("problem IS NOT NULL")


MANIFEST = "file string, rows long, bytes long, sha256 string"


def _new_folder(source: str, target: str) -> str:
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the target must be a new folder")
    return target.rstrip("/")


def unquote_rewrite(spark: SparkSession, source: str, target: str, files: Sequence[str] | None = None, unbroken: Collection[str] = ()) -> None:
    """Rewrite the CSV files of a folder with minimal quoting into a new folder.

    Tables named in ``unbroken`` hold no line breaks inside texts and are read in
    parallel splits. With ``files`` only those are rewritten, and the folder is not listed.
    """
    target = _new_folder(source, target)
    for name, file in list_csv(spark, source, files).items():
        write_import_csv(read_text_csv(spark, file, name not in unbroken), f"{target}/{name}.csv")


def logical_columns(df: DataFrame) -> list[str]:
    """Text columns that hold nothing but true and false."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    found = df.agg(*[F.bool_and(F.col(f"`{c}`").isin(*TRUE, *FALSE)).alias(c) for c in texts]).head() if texts else None
    return [c for c in texts if found[c]]


def repair_extract(
    spark: SparkSession, source: str, target: str, files: Sequence[str] | None = None, repaired: Collection[str] | None = None,
    stamps: Sequence[str] = ("DateCreated", "DateUpdated"), unbroken: Collection[str] = (),
) -> None:
    """Rewrite the extract's files without needless quotes; in the ``repaired`` ones also
    write ``stamps`` as time text and true and false as 1 and 0."""
    target = _new_folder(source, target)
    repaired = REPAIRED_FILES if repaired is None else repaired
    for name, file in list_csv(spark, source, UNQUOTED_FILES if files is None else files).items():
        df = read_text_csv(spark, file, name not in unbroken)
        if name in repaired:
            df = df.withColumns({c: F.when(F.col(f"`{c}`").isin(*TRUE), "1").when(F.col(f"`{c}`").isin(*FALSE), "0") for c in logical_columns(df)})
            df = df.withColumns({c: as_time_text(parse_dt(F.col(c))) for c in stamps if c in df.columns})
        write_import_csv(df, f"{target}/{name}.csv")


# Spellings of true and false in the extract.
TRUE, FALSE = ("TRUE", "T", "true", "True"), ("FALSE", "F", "false", "False")

# Files of the standard extract that are rewritten without needless quotes.
UNQUOTED_FILES = (
    "Affiliation", "Assessment", "AssessmentQuestions", "AssessmentResults", "Client",
    "CurrentLivingSituation", "Disabilities", "EmploymentEducation", "Enrollment",
    "EnrollmentCoC", "Event", "Exit", "Export", "Funder", "HealthAndDV", "IncomeBenefits",
    "Inventory", "ProjectCoC", "Services", "User",
)

# Those of them whose stamps and logicals are repaired.
REPAIRED_FILES = (
    "Client", "CurrentLivingSituation", "Disabilities", "EmploymentEducation", "Enrollment",
    "EnrollmentCoC", "Exit", "HealthAndDV", "IncomeBenefits", "Services",
)
