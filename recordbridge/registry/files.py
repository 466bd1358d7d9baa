"""Sources and sinks: test tables written as files and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..operators.joins import ns_join
from ..session import shared_folder
from ..sources import readers, writers
from .base import Tables, nullif, query


def new_folder(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/files-{uuid.uuid4().hex}"


def order_file(t: Tables):
    """Orders with a null, a logical, a day and a time, text that needs quotes, and text with outer blanks."""
    return t.orders.select(
        F.col("o_orderkey").alias("OrderID"), nullif("o_orderstatus", "P").alias("Status"), (F.col("o_totalprice") > 250000).alias("Large"),
        F.col("o_orderdate").cast("date").alias("Day"), F.col("o_orderdate").alias("Made"), F.col("o_totalprice").alias("Price"),
        F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", twice')).alias("Note"), F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("Padded"),
    )


ORDER_SQL = """SELECT o_orderkey AS "OrderID", nullif(o_orderstatus, 'P') AS "Status", CAST(o_totalprice > 250000 AS INTEGER) AS "Large",
 strftime(o_orderdate, '%Y-%m-%d') AS "Day", strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "Made", o_totalprice AS "Price", 'say "' || o_orderpriority || '", twice' AS "Note", '  ' || o_orderpriority || ' ' AS "Padded" FROM orders"""


def as_text(df):
    return df.withColumns({"Day": dates.as_day_text(F.col("Day")), "Made": dates.as_time_text(F.col("Made"))})


@query("write_import_csv", """
SELECT CAST(o_orderkey AS VARCHAR) AS "OrderID", nullif(o_orderstatus, 'P') AS "Status", CASE WHEN o_totalprice > 250000 THEN '1' ELSE '0' END AS "Large",
 strftime(o_orderdate, '%Y-%m-%d') AS "Day", strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "Made", CAST(o_totalprice AS VARCHAR) AS "Price", 'say "' || o_orderpriority || '", twice' AS "Note", '  ' || o_orderpriority || ' ' AS "Padded" FROM orders""")
def write_import_csv(t: Tables):
    path = new_folder(t)
    writers.write_import_csv(order_file(t), path)
    return readers.read_text_csv(t.spark, path, line_breaks=False)


@query("read_typed_csv", ORDER_SQL)
def read_typed_csv(t: Tables):
    path = new_folder(t)
    writers.write_import_csv(order_file(t), path)
    return as_text(readers.read_typed_csv(t.spark, path, "nciDTncc", line_breaks=False))


SPOILT_SQL = """spoilt AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS "Price",
  CASE WHEN o_orderkey % 70 = 0 THEN 'soon' WHEN o_orderkey % 70 = 1 THEN '1996-13-45' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Day",
  CASE WHEN o_orderkey % 30 = 0 THEN NULL WHEN o_orderkey % 30 = 1 THEN 'maybe' ELSE 'true' END AS "Open" FROM orders),
 texts AS (SELECT *, k || ',' || "Price" || ',' || "Day" || ',' || coalesce("Open", '') AS row_text FROM spoilt),
 bad AS (SELECT row_text, 'Price' AS "column", "Price" AS value, 'double' AS expected FROM texts WHERE "Price" = 'n/a'
  UNION ALL SELECT row_text, 'Day', "Day", 'date' FROM texts WHERE "Day" IN ('soon', '1996-13-45') UNION ALL SELECT row_text, 'Open', "Open", 'boolean' FROM texts WHERE "Open" = 'maybe')"""


def spoilt_file(t: Tables) -> str:
    """Orders as a file in which some prices, days and logicals cannot be read."""
    k, path = F.col("o_orderkey"), new_folder(t)
    day = F.when(k % 70 == 0, "soon").when(k % 70 == 1, "1996-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = t.orders.select(
        k.alias("OrderID"), F.when(k % 50 == 0, "n/a").otherwise(F.floor("o_totalprice").cast("long").cast("string")).alias("Price"), day.alias("Day"),
        F.when(k % 30 == 0, F.lit(None)).when(k % 30 == 1, "maybe").otherwise("true").alias("Open"),
    )
    writers.write_import_csv(rows, f"{path}/order.csv")
    return path


@query("rejected_values", f"WITH {SPOILT_SQL} SELECT * FROM bad")
def rejected_values(t: Tables):
    return readers.read_checked_csv(t.spark, f"{spoilt_file(t)}/order.csv", "nnDl", line_breaks=False).rejects.drop("file")


@query("rejected_dump_values", f"""
WITH {SPOILT_SQL} SELECT 'order' AS "table", "column", value, expected, count(*) AS n FROM bad GROUP BY ALL
UNION ALL SELECT 'nation', 'n_name', n_name, 'int', count(*) FROM nation GROUP BY ALL""")
def rejected_dump_values(t: Tables):
    """How often each value of the files of a folder was rejected."""
    path = spoilt_file(t)
    writers.write_import_csv(t.nation, f"{path}/nation.csv")
    nation = T.StructType([T.StructField(f.name, T.IntegerType() if f.name == "n_name" else f.dataType) for f in t.nation.schema])
    schemas = {"order": T.StructType.fromDDL("OrderID long, Price double, Day date, Open boolean"), "nation": nation}
    return readers.read_checked_dump(t.spark, path, schemas, unbroken=["order", "nation"])[1].groupBy("table", "column", "value", "expected").agg(F.count("*").alias("n"))


@query("read_dump_dir", """
SELECT c_custkey, c_name, n_name, 'a' || chr(10) || 'b' AS note FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def read_dump_dir(t: Tables):
    path = new_folder(t)
    writers.write_import_csv(t.customer.withColumn("note", F.lit("a\nb")), f"{path}/customer.csv")
    writers.write_import_csv(t.nation, f"{path}/nation.csv")
    schemas = {"customer": T.StructType([*t.customer.schema.fields, T.StructField("note", T.StringType())]), "nation": t.nation.schema}
    tables = readers.read_dump_dir(t.spark, path, schemas, views=False, unbroken=["nation"])
    both = ns_join(tables["customer"], tables["nation"], [("c_nationkey", "n_nationkey")], nulls_match=False)
    return both.select("c_custkey", "c_name", "n_name", "note")


@query("read_sheet_export", """
SELECT p_partkey, p_name, CASE WHEN p_size <> 7 THEN strftime(DATE '1899-12-30' + CAST(40000 + p_size AS INTEGER), '%Y-%m-%d') END AS day FROM part""")
def read_sheet_export(t: Tables):
    path = new_folder(t)
    writers.write_import_csv(t.part.select("p_partkey", "p_name", F.when(F.col("p_size") == 7, "unknown").otherwise((F.col("p_size") + 40000).cast("string")).alias("day")), path)
    sheet = readers.read_sheet_export(t.spark, path, T.StructType.fromDDL("p_partkey long, p_name string, day string"), ["day"])
    return sheet.withColumn("day", dates.as_day_text(F.col("day")))


@query("import_set_manifest", """
WITH n AS (SELECT *, row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1 AS i FROM customer),
 f AS (SELECT i // 400 AS file, count(*) AS rows, 'c_custkey,c_name,c_mktsegment,rich' || chr(10) || string_agg(c_custkey || ',' || c_name || ',' || c_mktsegment || ',' ||
   CASE WHEN c_acctbal > 500 THEN '1' ELSE '0' END || chr(10), '' ORDER BY i) AS text FROM n GROUP BY 1)
SELECT 'Client-' || lpad(CAST(file + 1 AS VARCHAR), 5, '0') || '.csv' AS file, rows, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM f""")
def import_set_manifest(t: Tables):
    """Written twice, from tables laid out differently; the manifest of the second, if all files are as it says and equal."""
    people = t.customer.select("c_custkey", "c_name", "c_mktsegment", (F.col("c_acctbal") > 500).alias("rich"))
    first, second = new_folder(t), new_folder(t)
    one = writers.write_import_set(people, first, "Client", ["c_mktsegment", "c_custkey"], 400, unique=True)
    two = writers.write_import_set(people.repartition(5, "c_name"), second, "Client", ["c_mktsegment", "c_custkey"], 400, unique=True)
    broken = writers.broken_files(t.spark, second)
    return two.join(one, ["file", "rows", "bytes", "sha256"], "left_semi").join(broken, "file", "left_anti")


@query("unquote_rewrite", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def unquote_rewrite(t: Tables):
    quoted, plain = new_folder(t), new_folder(t)
    t.supplier.select("s_suppkey", "s_name", "s_nationkey").write.options(header=True, quoteAll=True).csv(f"{quoted}/Supplier.csv")
    writers.unquote_rewrite(t.spark, quoted, plain)
    return readers.read_text_csv(t.spark, f"{plain}/Supplier.csv")


@query("repair_extract", """
SELECT 'Client' AS file, CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal > 0 THEN '1' ELSE '0' END AS flag, strftime(DATE '2021-02-01' + CAST(c_custkey % 28 AS INTEGER), '%Y-%m-%d 00:00:00') AS made FROM customer
UNION ALL SELECT 'Funder', CAST(s_suppkey AS VARCHAR), CASE WHEN s_acctbal > 0 THEN 'TRUE' ELSE 'FALSE' END, '2/' || (s_suppkey % 28 + 1) || '/2021' FROM supplier""")
def repair_extract(t: Tables):
    quoted, plain = new_folder(t), new_folder(t)

    def extract(df, key, balance, name):
        day = F.concat(F.lit("2/"), (F.col(key) % 28 + 1).cast("string"), F.lit("/2021"))
        rows = df.select(F.col(key).alias("id"), F.when(F.col(balance) > 0, "TRUE").otherwise("FALSE").alias("flag"), day.alias("DateCreated"))
        rows.write.options(header=True, quoteAll=True).csv(f"{quoted}/{name}.csv")

    extract(t.customer, "c_custkey", "c_acctbal", "Client")
    extract(t.supplier, "s_suppkey", "s_acctbal", "Funder")
    writers.repair_extract(t.spark, quoted, plain, ["Client", "Funder"], unbroken=["Client"])
    read = readers.read_dump_dir(t.spark, plain, views=False, unbroken=["Client", "Funder"], names=["Client", "Funder"])
    return read["Client"].withColumn("file", F.lit("Client")).unionByName(read["Funder"].withColumn("file", F.lit("Funder"))).select("file", "id", "flag", F.col("DateCreated").alias("made"))


@query("literal_table", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' END AS wait FROM orders""")
def literal_table(t: Tables):
    waits = readers.literal_table(t.spark, [("1-URGENT", "now"), ("2-HIGH", "soon")], "o_orderpriority string, wait string")
    return ns_join(t.orders.select("o_orderkey", "o_orderpriority"), waits, "o_orderpriority", "left").select("o_orderkey", "wait")
