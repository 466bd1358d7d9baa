"""Null rules, projection, translation, joins and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes, dates, nulls, text
from ..operators import joins, shape, translate
from ..sources.writers import format_datetimes
from .base import Tables, money, nullif, query

# --- null rules -----------------------------------------------------------------


@query("ns_join", """
WITH l AS (SELECT nullif(p_brand, 'Brand#1') AS brand, p_size, count(*) AS n FROM part GROUP BY 1, 2),
     r AS (SELECT nullif(p_brand, 'Brand#2') AS brand, count(*) AS n FROM part GROUP BY 1)
SELECT coalesce(l.brand, r.brand) AS brand, p_size, l.n AS n_x, r.n AS n_y
FROM l FULL JOIN r ON l.brand IS NOT DISTINCT FROM r.brand""")
def ns_join(t: Tables):
    left = t.part.groupBy(nullif("p_brand", "Brand#1").alias("brand"), "p_size").agg(F.count("*").alias("n"))
    right = t.part.groupBy(nullif("p_brand", "Brand#2").alias("brand")).agg(F.count("*").alias("n"))
    return joins.ns_join(left, right, "brand", "full")


@query("not_in", """
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer
WHERE nullif(c_mktsegment, 'BUILDING') IS NULL OR c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')""")
def not_in(t: Tables):
    c = t.customer.select("c_custkey", nullif("c_mktsegment", "BUILDING").alias("segment"))
    return c.where(nulls.not_in(F.col("segment"), ["MACHINERY", "FURNITURE"]))


@query("tri_if", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'north' ELSE 'south' END AS area
FROM customer""")
def tri_if(t: Tables):
    known = nullif("c_mktsegment", "BUILDING")
    return t.customer.select("c_custkey", nulls.tri_if(known == "MACHINERY", "north", "south").alias("area"))


@query("strict_agg", """
WITH c AS (SELECT c_nationkey, c_mktsegment, CASE WHEN c_acctbal <= 9500 THEN CAST(c_acctbal AS DECIMAL(12,2)) END AS bal FROM customer)
SELECT c_nationkey, c_mktsegment,
  CASE WHEN count(bal) = count(*) THEN CAST(min(bal) AS DOUBLE) END AS lo,
  CASE WHEN count(bal) = count(*) THEN CAST(max(bal) AS DOUBLE) END AS hi,
  CASE WHEN count(bal) = count(*) THEN CAST(sum(bal) AS DOUBLE) END AS total
FROM c GROUP BY 1, 2""")
def strict_agg(t: Tables):
    c = t.customer.withColumn("bal", F.when(F.col("c_acctbal") <= 9500, money("c_acctbal")))
    return c.groupBy("c_nationkey", "c_mktsegment").agg(
        nulls.strict_agg(F.min, F.col("bal")).cast("double").alias("lo"),
        nulls.strict_agg(F.max, F.col("bal")).cast("double").alias("hi"),
        nulls.strict_agg(F.sum, F.col("bal")).cast("double").alias("total"),
    )


@query("paste", """
SELECT p_partkey, p_name || ': ' || CASE WHEN p_brand = 'Brand#1' THEN 'NA' ELSE p_brand END || ': ' || p_size AS label FROM part""")
def paste(t: Tables):
    label = nulls.paste(F.col("p_name"), nullif("p_brand", "Brand#1"), F.col("p_size"), sep=": ")
    return t.part.select("p_partkey", label.alias("label"))


# --- projection and filters -------------------------------------------------------


@query("format_datetimes", """
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events""")
def format_dates(t: Tables):
    return format_datetimes(t.events.select("event_id", "user_id", "ts"), {"ts": "yyyy-MM-dd HH:mm:ss"})


@query("shape", """
SELECT p_partkey AS id, p_name, p_type, p_retailprice AS price FROM part""")
def shape_query(t: Tables):
    return shape.shape(t.part, ("id", "p_partkey"), "p_name:p_type", ("price", "#6"), drop=["p_b*"])


@query("clean_names", """
SELECT c_custkey AS cust_key, c_name AS full_name, c_nationkey AS nation_key, c_acctbal AS acct_bal, c_mktsegment AS acct_bal_2 FROM customer""")
def clean_names(t: Tables):
    return shape.clean_names(t.customer.toDF("Cust Key", "(Full) Name", "nationKey", "Acct.Bal", "Acct Bal"))


@query("active_filter", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate >= TIMESTAMP '1998-01-01'""")
def active_filter(t: Tables):
    keep = (
        (F.col("o_orderstatus") == "O")
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & (F.col("o_orderdate") >= dates.day("1998-01-01").cast("timestamp_ntz"))
    )
    return t.orders.where(keep).select("o_orderkey", "o_custkey", "o_orderpriority")


RULES = {"1-URGENT": ("A", "R"), "2-HIGH": ("N",), "5-LOW": ("A", "N")}


@query("rule_matrix_filter", """
SELECT l_orderkey, l_partkey, o_orderpriority, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE (o_orderpriority = '1-URGENT' AND l_returnflag IN ('A', 'R')) OR (o_orderpriority = '2-HIGH' AND l_returnflag = 'N')
   OR (o_orderpriority = '5-LOW' AND l_returnflag IN ('A', 'N'))""")
def rule_matrix_filter(t: Tables):
    lines = joins.ns_join(
        t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag"), t.orders.select("o_orderkey", "o_orderpriority"),
        [("l_orderkey", "o_orderkey")], nulls_match=False,
    )
    return translate.rule_matrix_filter(lines, RULES, "o_orderpriority", "l_returnflag")


@query("code_bucket", """
SELECT DISTINCT p_brand, p_size, CASE WHEN p_size BETWEEN 1 AND 7 THEN 'Base'
  WHEN p_size BETWEEN 8 AND 11 OR (p_size = 46 AND p_type = 'PROMO') THEN 'Base'
  WHEN p_size IN (20, 21) THEN 'Special' WHEN p_brand = 'Brand#3' THEN 'Brand' ELSE 'Base' END AS bucket FROM part""")
def code_bucket(t: Tables):
    size = F.col("p_size")
    rules = [
        (size.between(1, 7), "Small"),
        (size.between(8, 11) | ((size == 46) & (F.col("p_type") == "PROMO")), "Medium"),
        (size.isin(20, 21), "Special"),
        (F.col("p_brand") == "Brand#3", "Brand"),
    ]
    bucket = codes.code_bucket(rules, "Other", {"Base": ("Other", "Small", "Medium")})
    return t.part.select("p_brand", "p_size", bucket.alias("bucket")).distinct()


@query("template_columns", """
SELECT p_partkey AS id, p_name AS name, 1 AS status, '' AS note, p_size + 100 AS ref, 'default' AS screen FROM part""")
def template_columns(t: Tables):
    named = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_size")
    constants = {"status": 1, "note": "", "screen": "default", "ref": F.col("p_size") + 100}
    return shape.template_columns(named, constants, ["id", "name", "status", "note", "ref", "screen"])


@query("default_null", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) AS segment, coalesce(nullif(c_nationkey, 3), 0) AS nation FROM customer""")
def default_null(t: Tables):
    return t.customer.select(
        "c_custkey",
        nulls.default_null(nullif("c_mktsegment", "BUILDING"), F.col("c_name")).alias("segment"),
        nulls.default_null(nullif("c_nationkey", 3), 0).alias("nation"),
    )


@query("across_yes_no", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS f_done,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS f_urgent, o_orderstatus AS other FROM orders""")
def across_yes_no(t: Tables):
    flags = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N").alias("f_done"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Y").otherwise("N").alias("f_urgent"),
        F.col("o_orderstatus").alias("other"),
    )
    return shape.across(flags, lambda c: c.startswith("f_"), codes.yes_no)


@query("threshold_by_type", """
SELECT p_partkey, CASE WHEN p_size IN (3, 9) THEN 365 WHEN p_size = 2 THEN 120 ELSE 30 END AS threshold FROM part""")
def threshold_by_type(t: Tables):
    return t.part.select("p_partkey", codes.threshold_by_type(F.col("p_size")).alias("threshold"))


@query("open_status", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' OR o_orderdate > TIMESTAMP '2000-01-01' THEN 1 ELSE 0 END AS status FROM orders""")
def open_status(t: Tables):
    end = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", dates.open_status(end, dates.day("2000-01-01")).alias("status"))


# --- codes and crosswalks ---------------------------------------------------------


@query("recode_literal", """
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'LARGE' THEN 3 END AS code FROM part""")
def recode_literal(t: Tables):
    return t.part.select("p_partkey", codes.recode_literal(F.col("p_type"), {"PROMO": 1, "SMALL": 2, "LARGE": 3}).alias("code"))


@query("recode_lookup", """
SELECT o_orderkey, a.n_nationkey AS home, b.n_nationkey AS work FROM
 (SELECT o_orderkey, 'NATION_' || (o_custkey % 30) AS h, 'NATION_' || (o_custkey % 25) AS w FROM orders) o
 LEFT JOIN nation a ON a.n_name = h LEFT JOIN nation b ON b.n_name = w""")
def recode_lookup(t: Tables):
    lookup = t.nation.select(F.col("n_name").alias("Value"), F.col("n_nationkey").alias("ReferenceNo"))
    rows = t.orders.select(
        "o_orderkey",
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % 30).cast("string")).alias("home"),
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string")).alias("work"),
    )
    return translate.recode_lookup(rows, {"home": lookup, "work": lookup})


def provider_table(t: Tables):
    """Suppliers as providers: every tenth one is the parent of the next nine."""
    return t.supplier.select(
        F.col("s_suppkey").alias("provider_id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 500, F.col("s_suppkey") - F.col("s_suppkey") % 10).alias("hud_organization_id"),
        (F.col("s_acctbal") > 0).alias("active"),
        F.col("s_nationkey"),
    )


PROVIDER_SQL = """provider AS (SELECT s_suppkey AS provider_id, s_name AS name,
  CASE WHEN s_acctbal > 500 THEN s_suppkey - s_suppkey % 10 END AS hud_organization_id, s_acctbal > 0 AS active, s_nationkey FROM supplier)"""


@query("self_parent_join", f"""
WITH {PROVIDER_SQL} SELECT c.provider_id AS "ProjectID", c.name AS "ProjectName", c.hud_organization_id AS "AgencyID", p.name AS "AgencyName"
FROM provider c LEFT JOIN provider p ON c.hud_organization_id = p.provider_id WHERE c.active""")
def self_parent_join(t: Tables):
    return translate.with_parent(provider_table(t)).select("ProjectID", "ProjectName", "AgencyID", "AgencyName")


NAME_FIXES, AGENCY_FIXES = {3: "Moved House", 14: "Second House"}, {20: "Central Intake", 30: "Other Intake"}
PROJECTS_SQL = PROVIDER_SQL + """, moves AS (SELECT n_nationkey AS id, n_regionkey * 10 AS parent FROM nation WHERE n_regionkey > 1),
 projects AS (SELECT c.provider_id AS "Legacy_ProgramID",
   CASE c.provider_id WHEN 3 THEN 'Moved House' WHEN 14 THEN 'Second House' ELSE c.name END AS "Legacy_ProgramName",
   coalesce(m.parent, c.hud_organization_id) AS "Legacy_AgencyID",
   CASE coalesce(m.parent, c.hud_organization_id) WHEN 20 THEN 'Central Intake' WHEN 30 THEN 'Other Intake' ELSE p.name END AS "Legacy_AgencyName"
 FROM provider c LEFT JOIN moves m ON m.id = c.provider_id
 LEFT JOIN provider p ON p.provider_id = coalesce(m.parent, c.hud_organization_id) WHERE c.active)"""


def projects_table(t: Tables):
    moves = t.nation.where("n_regionkey > 1").select(
        F.col("n_nationkey").cast("long").alias("Legacy_ProgramID"), (F.col("n_regionkey") * 10).cast("long").alias("correct_Legacy_AgencyID")
    )
    return translate.build_projects(provider_table(t), moves, NAME_FIXES, AGENCY_FIXES)


@query("override_then_join", f"WITH {PROJECTS_SQL} SELECT * FROM projects")
def override_then_join(t: Tables):
    return projects_table(t)


CROSSWALK_SQL = PROJECTS_SQL + """, in_scope AS (SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_nationkey < 20),
 target AS (SELECT s_suppkey + 1000 AS "Target_ProgramID", s_name AS name, s_nationkey + 100 AS "Target_AgencyID" FROM supplier WHERE s_acctbal > 1500),
 crosswalk AS (SELECT p."Legacy_AgencyID", p."Legacy_AgencyName", i.id AS "Legacy_ProgramID", i.name AS "Legacy_ProgramName",
   t."Target_AgencyID", t."Target_ProgramID", i.name AS "Target_ProgramName"
 FROM in_scope i LEFT JOIN projects p ON p."Legacy_ProgramID" = i.id AND p."Legacy_ProgramName" = i.name LEFT JOIN target t ON t.name = i.name)"""


def crosswalk_tables(t: Tables):
    in_scope = t.supplier.where("s_nationkey < 20").select(
        F.col("s_suppkey").alias("Legacy_ProgramID"), F.col("s_name").alias("Legacy_ProgramName")
    )
    target = t.supplier.where("s_acctbal > 1500").select(
        (F.col("s_nationkey") + 100).alias("Target_AgencyID"),
        (F.col("s_suppkey") + 1000).alias("Target_ProgramID"),
        F.col("s_name").alias("Target_ProgramName"),
    )
    return translate.build_crosswalk(projects_table(t), in_scope, target)


@query("build_crosswalk", f"""
WITH {CROSSWALK_SQL} SELECT *, 'all' AS list FROM crosswalk UNION ALL SELECT *, 'unmatched' FROM crosswalk WHERE "Target_ProgramID" IS NULL""")
def build_crosswalk(t: Tables):
    crosswalk, unmatched = crosswalk_tables(t)
    return crosswalk.withColumn("list", F.lit("all")).unionByName(unmatched.withColumn("list", F.lit("unmatched")))


@query("extend_crosswalk", """
WITH cur AS (SELECT s_suppkey AS id, s_name AS name, s_nationkey AS agency FROM supplier WHERE s_acctbal > 5000),
 add AS (SELECT DISTINCT s_suppkey AS id, s_name AS name, s_nationkey AS agency FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE s_acctbal <= 2000),
 fin AS (SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_nationkey < 12),
 grown AS (SELECT * FROM cur UNION ALL SELECT * FROM add)
SELECT g.id, g.name, g.agency, CASE WHEN fin.id IS NULL THEN 'No' ELSE 'Yes' END AS "GettingData"
FROM grown g LEFT JOIN fin ON fin.id = g.id AND fin.name = g.name""")
def extend_crosswalk(t: Tables):
    rows = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("agency"), "s_acctbal")
    current = rows.where("s_acctbal > 5000").drop("s_acctbal")
    repeated = joins.ns_join(rows.where("s_acctbal <= 2000").drop("s_acctbal"), t.lineitem.select(F.col("l_suppkey").alias("id")), "id")
    final = t.supplier.where("s_nationkey < 12").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("1995-01-01").alias("OperatingStart")
    )
    return translate.extend_crosswalk(current, repeated, final, ["id", "name"])


@query("agency_fallback", """
SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_suppkey = 7 THEN 134 WHEN l_suppkey = 12 THEN 9
  WHEN s_acctbal > 2000 THEN s_nationkey + 100 WHEN n_regionkey = 2 THEN 300 ELSE 299 END AS agency
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def agency_fallback(t: Tables):
    agencies = joins.left_chain(t.supplier, (t.nation, [("s_nationkey", "n_nationkey")])).select(
        "s_suppkey", F.when(F.col("s_acctbal") > 2000, F.col("s_nationkey") + 100).alias("agency"), "n_regionkey"
    )
    lines = joins.ns_join(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey"), agencies, [("l_suppkey", "s_suppkey")], nulls_match=False)
    default = F.when(F.col("n_regionkey") == 2, 300).otherwise(299)
    agency = translate.agency_fallback(F.col("l_suppkey"), F.col("agency"), {7: 134, 12: 9}, default)
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", agency.alias("agency"))


@query("normalise_labels", """
SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Handy' WHEN p_type = 'PROMO' THEN 'Promo' ELSE p_type END AS label FROM part""")
def normalise_labels(t: Tables):
    spellings = {"Handy": ("SMALL", "MEDIUM"), "Promo": ("PROMO",)}
    return t.part.select("p_partkey", codes.normalise_labels(F.col("p_type"), spellings).alias("label"))


# --- joins ------------------------------------------------------------------------


@query("inner_by_name", """
SELECT o_orderkey, n_name, n_regionkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_name = 'NATION_' || (c_nationkey + 3)""")
def inner_by_name(t: Tables):
    named = t.customer.select("c_custkey", F.concat(F.lit("NATION_"), (F.col("c_nationkey") + 3).cast("string")).alias("n_name"))
    people = joins.ns_join(named, t.nation.select("n_name", "n_regionkey"), "n_name", nulls_match=False)
    orders = joins.ns_join(t.orders.select("o_orderkey", "o_custkey"), people, [("o_custkey", "c_custkey")], nulls_match=False)
    return orders.select("o_orderkey", "n_name", "n_regionkey")


@query("left_chain", """
SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority, c_name, n_name, p_brand, s_name
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def left_chain(t: Tables):
    out = joins.left_chain(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        (t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), [("l_orderkey", "o_orderkey")]),
        (t.customer.where("c_acctbal > 0").select("c_custkey", "c_name", "c_nationkey"), [("o_custkey", "c_custkey")]),
        (t.nation.select("n_nationkey", "n_name"), [("c_nationkey", "n_nationkey")]),
        (t.part.select("p_partkey", "p_brand"), [("l_partkey", "p_partkey")]),
        (t.supplier.select("s_suppkey", "s_name"), [("l_suppkey", "s_suppkey")]),
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority", "c_name", "n_name", "p_brand", "s_name")


@query("right_scope", """
SELECT c_custkey AS custkey, o_orderkey, o_orderstatus FROM (SELECT * FROM orders WHERE o_orderstatus = 'F')
RIGHT JOIN (SELECT * FROM customer WHERE c_nationkey < 5) ON o_custkey = c_custkey""")
def right_scope(t: Tables):
    closed = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_orderstatus")
    scope = t.customer.where("c_nationkey < 5").select(F.col("c_custkey").alias("custkey"))
    return joins.ns_join(closed, scope, "custkey", "right")


@query("full_coalesce", """
WITH a AS (SELECT nullif(o_custkey, 7) AS k, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
 b AS (SELECT nullif(c_custkey, 9) AS k, c_mktsegment FROM customer WHERE c_acctbal > 0),
 c AS (SELECT user_id AS k, count(*) AS n_events FROM events GROUP BY 1),
 ab AS (SELECT coalesce(a.k, b.k) AS k, n_orders, c_mktsegment FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k)
SELECT coalesce(ab.k, c.k) AS k, n_orders, c_mktsegment, n_events FROM ab FULL JOIN c ON ab.k IS NOT DISTINCT FROM c.k""")
def full_coalesce(t: Tables):
    a = t.orders.where("o_orderstatus = 'F'").groupBy(nullif("o_custkey", 7).alias("k")).agg(F.count("*").alias("n_orders"))
    b = t.customer.where("c_acctbal > 0").select(nullif("c_custkey", 9).alias("k"), "c_mktsegment")
    c = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("n_events"))
    return joins.full_coalesce([a, b, c], ["k"], unique_keys=True)


@query("full_coalesce_repeated", """
WITH a AS (SELECT nullif(n_nationkey, 4) AS k, n_name FROM nation), b AS (SELECT DISTINCT nullif(c_nationkey, 5) AS k, c_mktsegment FROM customer), c AS (SELECT DISTINCT s_nationkey + 10 AS k, s_suppkey % 3 AS third FROM supplier),
 ab AS (SELECT coalesce(a.k, b.k) AS k, n_name, c_mktsegment FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k)
SELECT coalesce(ab.k, c.k) AS k, n_name, c_mktsegment, third FROM ab FULL JOIN c ON ab.k IS NOT DISTINCT FROM c.k""")
def full_coalesce_repeated(t: Tables):
    """Keys that occur several times in a frame: the chain of full joins."""
    a = t.nation.select(F.nullif("n_nationkey", F.lit(4)).alias("k"), "n_name")
    b = t.customer.select(F.nullif("c_nationkey", F.lit(5)).alias("k"), "c_mktsegment").distinct()
    c = t.supplier.select((F.col("s_nationkey") + 10).alias("k"), (F.col("s_suppkey") % 3).alias("third")).distinct()
    return joins.full_coalesce([a, b, c], ["k"])


@query("semi_restrict", """
SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""")
def semi_restrict(t: Tables):
    large = t.orders.where("o_totalprice > 450000").select("o_custkey")
    return joins.semi_restrict(t.customer.select("c_custkey", "c_name"), large, [("c_custkey", "o_custkey")], nulls_match=False)


@query("anti_exclude", """
WITH p AS (SELECT p_partkey, nullif(p_brand, 'Brand#1') AS brand, nullif(p_size, 5) AS size, p_type FROM part)
SELECT p_partkey, brand, size FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.p_type = 'PROMO'
  AND q.brand IS NOT DISTINCT FROM p.brand AND q.size IS NOT DISTINCT FROM p.size)""")
def anti_exclude(t: Tables):
    p = t.part.select("p_partkey", nullif("p_brand", "Brand#1").alias("brand"), nullif("p_size", 5).alias("size"), "p_type")
    promo = p.where("p_type = 'PROMO'").select("brand", "size")
    return joins.anti_exclude(p.select("p_partkey", "brand", "size"), promo, ["brand", "size"])


@query("natural_anti", """
SELECT l_orderkey, l_returnflag, l_linestatus FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders
  WHERE o_orderkey = l_orderkey AND o_orderstatus = l_linestatus)""")
def natural_anti(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("l_linestatus"))
    return joins.natural_join(lines, orders, "left_anti")


@query("interval_join", """
WITH e AS (SELECT o_custkey AS custkey, l_orderkey, l_partkey, l_shipdate AS moment FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 s AS (SELECT o_custkey, o_orderkey, o_orderdate AS entry, CASE WHEN o_totalprice > 490000 THEN TIMESTAMP '2001-12-31'
   ELSE o_orderdate + INTERVAL 30 DAY END AS shut FROM orders)
SELECT custkey, l_orderkey, l_partkey, strftime(moment, '%Y-%m-%d') AS day, o_orderkey FROM e JOIN s ON o_custkey = custkey AND moment BETWEEN entry AND shut""")
def interval_join(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("entry"), "o_totalprice")
    events = joins.ns_join(
        t.lineitem.select("l_orderkey", "l_partkey", F.col("l_shipdate").alias("moment")),
        t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey")), [("l_orderkey", "o_orderkey")], nulls_match=False,
    )
    spans = orders.withColumn("shut", F.when(~(F.col("o_totalprice") > 490000), F.col("entry") + F.expr("INTERVAL 30 DAYS"))).drop("o_totalprice")
    inside = joins.interval_join(events, spans, [("custkey", "o_custkey")], "moment", "entry", "shut", dates.day("2001-12-31"))
    return inside.select("custkey", "l_orderkey", "l_partkey", dates.as_day_text(F.col("moment")).alias("day"), "o_orderkey")


@query("or_fallback_join", """
WITH p AS (SELECT 'c' || c_custkey AS id, 'NATION_' || (c_custkey % 40) AS city, 'NATION_' || c_nationkey AS county FROM customer
 UNION ALL SELECT 's' || s_suppkey, 'NATION_' || (s_suppkey % 40), 'NATION_' || s_nationkey FROM supplier)
SELECT id, city, county, coalesce(a.n_regionkey, b.n_regionkey) AS region FROM p LEFT JOIN nation a ON a.n_name = city LEFT JOIN nation b ON b.n_name = county""")
def or_fallback_join(t: Tables):
    def place(df, tag, key, nation):
        return df.select(
            F.concat(F.lit(tag), F.col(key).cast("string")).alias("id"),
            F.concat(F.lit("NATION_"), (F.col(key) % 40).cast("string")).alias("city"),
            F.concat(F.lit("NATION_"), F.col(nation).cast("string")).alias("county"),
        )

    places = place(t.customer, "c", "c_custkey", "c_nationkey").unionByName(place(t.supplier, "s", "s_suppkey", "s_nationkey"))
    return joins.fallback_join(places, t.nation, [("city", "n_name"), ("county", "n_name")], "n_regionkey", "region")


@query("many_to_many_guard", """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def fanout_report(t: Tables):
    return joins.fanout_report(t.lineitem, ["l_orderkey", "l_linenumber"])


# --- scalar functions -------------------------------------------------------------


@query("text_scalars", """
WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg, c_name || ' (' || c_mktsegment || ') x(' || c_nationkey || ')' AS txt FROM customer)
SELECT c_custkey, regexp_replace(txt, '\\(.*?\\)', '') AS stripped,
 CASE WHEN instr(txt, '(') > 0 THEN substr(txt, 1, instr(txt, '(') - 1) END AS cut,
 CASE WHEN instr(coalesce(seg, ''), 'N') > 0 THEN substr(seg, 1, instr(seg, 'N') - 1) END AS cut_n,
 seg || ' (HUD)' AS suffixed, length(txt) AS len, substr(txt, 1, 5) AS zip,
 contains(seg, 'MACH') AS holds, NOT contains(seg, 'MACH') AS lacks, starts_with(seg, 'F') AS starts,
 contains(txt, 'AUTO') OR contains(txt, 'HOUSE') AS any_of FROM c""")
def text_scalars(t: Tables):
    seg, txt = F.col("seg"), F.col("txt")
    c = t.customer.select(
        "c_custkey", nullif("c_mktsegment", "BUILDING").alias("seg"),
        F.concat(F.col("c_name"), F.lit(" ("), F.col("c_mktsegment"), F.lit(") x("), F.col("c_nationkey").cast("string"), F.lit(")")).alias("txt"),
    )
    flags = text.text_flags(seg, "MACH")
    return c.select(
        "c_custkey", text.strip_suffix(txt, r"\(.*?\)").alias("stripped"), text.cut_at_paren(txt).alias("cut"),
        text.cut_at_paren(F.regexp_replace(seg, "N", "(")).alias("cut_n"),
        text.suffix_if_present(seg, " (HUD)").alias("suffixed"), text.name_length(txt).alias("len"), text.short_zip(txt).alias("zip"),
        flags["holds"].alias("holds"), flags["lacks"].alias("lacks"), text.text_flags(seg, "F")["starts"].alias("starts"),
        text.contains_any(txt, ["AUTO", "HOUSE"]).alias("any_of"),
    )


@query("date_scalars", """
SELECT o_orderkey, strftime(least(coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END, TIMESTAMP '1999-06-01'), TIMESTAMP '1999-06-01'), '%Y-%m-%d') AS exit_adjust,
 CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS export_id, date_diff('microsecond', TIMESTAMP '1998-01-01 06:00:00', o_orderdate) / 86400000000.0 AS days,
 round_even(o_totalprice, 0) AS rounded, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp FROM orders""")
def date_scalars(t: Tables):
    as_of = F.lit("1999-06-01").cast("timestamp_ntz")
    ended = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey", dates.as_day_text(dates.as_of_exit(ended, as_of)).alias("exit_adjust"),
        dates.stamp_export_id(F.col("o_orderdate")).alias("export_id"),
        dates.days_between(F.col("o_orderdate"), F.lit("1998-01-01 06:00:00").cast("timestamp_ntz")).alias("days"),
        codes.round_even(F.col("o_totalprice")).alias("rounded"), dates.as_time_text(F.col("o_orderdate")).alias("stamp"),
    )


@query("squish_newlines", r"""
SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents""")
def squish_newlines(t: Tables):
    return t.documents.select("doc_id", text.squish_newlines(F.col("text")).alias("text"))


@query("address_line", """
WITH p AS (SELECT p_partkey, nullif(p_name, 'red ring') AS a1, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN p_brand END AS a2, nullif(p_type, 'PROMO') AS name FROM part)
SELECT p_partkey, CASE WHEN a1 IS NULL AND a2 IS NULL THEN 'Confidential - ' || coalesce(name, 'NA') WHEN a2 IS NULL THEN a1 WHEN a1 IS NULL THEN a2
 ELSE a1 || ' ' || a2 END AS address FROM p""")
def address_line(t: Tables):
    line2 = F.when(F.col("p_type").isin("SMALL", "LARGE"), F.col("p_brand"))
    return t.part.select("p_partkey", text.address_line(nullif("p_name", "red ring"), line2, nullif("p_type", "PROMO")).alias("address"))


@query("login_name", r"""
SELECT p_partkey, lower(substr(regexp_replace(p_name, '[[:punct:]]', '', 'g'), 1, 1) || coalesce(regexp_replace(nullif(p_brand, 'Brand#4') || '-' || p_type, '[[:punct:]]', '', 'g'), 'NA')) AS login FROM part""")
def login_name(t: Tables):
    last = F.concat(nullif("p_brand", "Brand#4"), F.lit("-"), F.col("p_type"))
    return t.part.select("p_partkey", text.login_name(F.col("p_name"), last).alias("login"))


STOP_LIST = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
CLEAN_SQL = (
    "regexp_replace(array_to_string([x FOR x IN regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+') IF NOT list_contains(["
    + STOP_LIST + "], x)], ''), '[^a-zA-Z\\s]+', '', 'g')"
)


@query("strip_stopwords", "SELECT doc_id, " + CLEAN_SQL.format("text") + " AS text FROM documents")
def strip_stopwords(t: Tables):
    return t.documents.select("doc_id", text.strip_stopwords(F.col("text")).alias("text"))


@query("excel_date", """
SELECT p_partkey, strftime(DATE '1899-12-30' + CAST(40000 + p_size AS INTEGER), '%Y-%m-%d') AS day FROM part""")
def excel_date(t: Tables):
    return t.part.select("p_partkey", dates.as_day_text(dates.excel_date(F.col("p_size") + 40000)).alias("day"))


def text_date():
    """Order dates in several spellings, one of them unreadable."""
    d, status = F.col("o_orderdate"), F.col("o_orderpriority")
    return (
        F.when(status == "1-URGENT", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(status == "2-HIGH", F.date_format(d, "yyyy-MM-dd"))
        .when(status == "3-MEDIUM", F.date_format(d, "M/d/yyyy"))
        .when(status == "5-LOW", F.lit("soon"))
    )


@query("parse_dt", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed FROM orders""")
def parse_dt(t: Tables):
    return t.orders.select("o_orderkey", dates.as_time_text(dates.parse_dt(text_date())).alias("parsed"))


@query("date_or_fallback", """
SELECT o_orderkey, strftime(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderdate ELSE TIMESTAMP '1999-09-09' END, '%Y-%m-%d') AS day FROM orders""")
def date_or_fallback(t: Tables):
    return t.orders.select("o_orderkey", dates.as_day_text(dates.date_or_fallback(text_date(), dates.day("1999-09-09"))).alias("day"))


@query("ssn_class", """
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 1000 THEN NULL WHEN c_nationkey = 3 THEN '123456789'
   WHEN c_nationkey = 4 THEN substr(CAST(100000000 + c_custkey * 7919 AS VARCHAR), 1, 8) WHEN c_nationkey = 5 THEN '900112222' WHEN c_nationkey = 6 THEN '666112222'
   WHEN c_nationkey = 7 THEN '101000001' WHEN c_nationkey = 8 THEN '101010000' ELSE CAST(100010000 + c_custkey * 7 + 1 AS VARCHAR) END AS num,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 500 THEN 99 WHEN c_acctbal < 1500 THEN 8 WHEN c_acctbal < 2000 THEN 9 WHEN c_acctbal < 3000 THEN 2 ELSE 1 END AS q FROM customer)
SELECT c_custkey, CASE WHEN (num IS NULL AND (q IS NULL OR q NOT IN (8, 9))) OR q IS NULL OR q = 99 THEN 'Missing' WHEN q IN (8, 9) THEN 'DKR'
  WHEN q = 2 OR length(num) <> 9 OR substr(num, 1, 3) IN ('000', '666') OR substr(num, 1, 1) = '9' OR substr(num, 4, 2) = '00' OR substr(num, 6, 4) = '0000'
   OR num IN ('111111111','222222222','333333333','444444444','555555555','777777777','888888888','123456789') THEN 'Invalid' ELSE 'ok' END AS ssn FROM c""")
def ssn_class(t: Tables):
    n, bal = F.col("c_nationkey"), F.col("c_acctbal")
    number = (
        F.when((F.col("c_mktsegment") == "BUILDING") & (bal < 1000), None)
        .when(n == 3, "123456789")
        .when(n == 4, F.substring((100000000 + F.col("c_custkey") * 7919).cast("string"), 1, 8))
        .when(n == 5, "900112222").when(n == 6, "666112222").when(n == 7, "101000001").when(n == 8, "101010000")
        .otherwise((100010000 + F.col("c_custkey") * 7 + 1).cast("string"))
    )
    quality = F.when(bal < 0, None).when(bal < 500, 99).when(bal < 1500, 8).when(bal < 2000, 9).when(bal < 3000, 2).otherwise(1)
    return t.customer.select("c_custkey", codes.ssn_class(number, quality).alias("ssn"))
