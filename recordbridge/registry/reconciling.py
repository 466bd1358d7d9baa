"""Comparing two systems, on halves and altered copies of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import strip_stopwords
from ..operators import guards, reconcile
from ..plans import helpers
from .base import Tables, money, nullif, query
from .basics import CLEAN_SQL
from .grouping import SNAPSHOT_SQL, snapshots


@query("table_diff", f"""
WITH {SNAPSHOT_SQL}, j AS (SELECT b.c_custkey AS bk, a.c_custkey AS ak, b.c_name IS DISTINCT FROM a.c_name AS d1, b.nation IS DISTINCT FROM a.nation AS d2, b.c_mktsegment IS DISTINCT FROM a.c_mktsegment AS d3
 FROM before b FULL JOIN after a ON a.c_custkey = b.c_custkey)
SELECT 'c_name' AS "column", count(*) FILTER (d1 AND ak IS NOT NULL AND bk IS NOT NULL) AS n FROM j
UNION ALL SELECT 'nation', count(*) FILTER (d2 AND ak IS NOT NULL AND bk IS NOT NULL) FROM j
UNION ALL SELECT 'c_mktsegment', count(*) FILTER (d3 AND ak IS NOT NULL AND bk IS NOT NULL) FROM j
UNION ALL SELECT '(only left)', count(*) FILTER (ak IS NULL) FROM j UNION ALL SELECT '(only right)', count(*) FILTER (bk IS NULL) FROM j""")
def table_diff(t: Tables):
    before, after = snapshots(t)
    return reconcile.table_diff(before, after, ["c_custkey"], ["c_name", "nation", "c_mktsegment"])


@query("table_diff_cells", f"""
WITH {SNAPSHOT_SQL}, j AS (SELECT coalesce(b.c_custkey, a.c_custkey) AS c_custkey, b.c_custkey AS bk, a.c_custkey AS ak, b.c_name AS n1, a.c_name AS n2, b.nation AS x1, a.nation AS x2,
  b.c_mktsegment AS s1, a.c_mktsegment AS s2 FROM before b FULL JOIN after a ON a.c_custkey = b.c_custkey), m AS (SELECT * FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL)
SELECT 'c_name' AS "column", c_custkey, n1 AS "left", n2 AS "right" FROM m WHERE n1 IS DISTINCT FROM n2
UNION ALL SELECT 'nation', c_custkey, CAST(x1 AS VARCHAR), CAST(x2 AS VARCHAR) FROM m WHERE x1 IS DISTINCT FROM x2
UNION ALL SELECT 'c_mktsegment', c_custkey, s1, s2 FROM m WHERE s1 IS DISTINCT FROM s2
UNION ALL SELECT CASE WHEN ak IS NULL THEN '(only left)' ELSE '(only right)' END, c_custkey, NULL, NULL FROM j WHERE ak IS NULL OR bk IS NULL""")
def table_diff_cells(t: Tables):
    before, after = snapshots(t)
    return reconcile.cell_diff(before, after, ["c_custkey"], ["c_name", "nation", "c_mktsegment"])


@query("table_diff_by_position", f"""
WITH {SNAPSHOT_SQL}, b AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS i FROM before), a AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS i FROM after),
 j AS (SELECT b.i AS bk, a.i AS ak, b.c_name IS DISTINCT FROM a.c_name AS d1, b.c_mktsegment IS DISTINCT FROM a.c_mktsegment AS d3 FROM b FULL JOIN a ON a.i = b.i)
SELECT 'c_name' AS "column", count(*) FILTER (d1 AND ak IS NOT NULL AND bk IS NOT NULL) AS n FROM j
UNION ALL SELECT 'c_mktsegment', count(*) FILTER (d3 AND ak IS NOT NULL AND bk IS NOT NULL) FROM j
UNION ALL SELECT '(only left)', count(*) FILTER (ak IS NULL) FROM j UNION ALL SELECT '(only right)', count(*) FILTER (bk IS NULL) FROM j""")
def table_diff_by_position(t: Tables):
    before, after = (reconcile.by_position(s, ["c_custkey"]) for s in snapshots(t))
    return reconcile.table_diff(before, after, ["position"], ["c_name", "c_mktsegment"])


@query("column_drift", """
SELECT o_orderkey, o_orderpriority AS priority_x, lower(o_orderpriority) AS priority_y FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000 AND lower(o_orderpriority) <> o_orderpriority""")
def column_drift(t: Tables):
    a = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    b = t.orders.where("o_totalprice > 200000").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.lower("o_orderpriority")).when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("priority")
    )
    return reconcile.column_drift(a, b, ["o_orderkey"], "priority")


@query("rowcount_drift", """
SELECT * FROM (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS n_x, count(*) FILTER (o_orderstatus = 'O') AS n_y FROM orders GROUP BY 1) WHERE n_x > 0 AND n_y > 0 AND n_x <> n_y""")
def rowcount_drift(t: Tables):
    return reconcile.rowcount_drift(t.orders.where("o_orderstatus = 'F'"), t.orders.where("o_orderstatus = 'O'"), ["o_custkey"])


@query("date_drift", """
WITH a AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events WHERE event_type IN ('click', 'view') GROUP BY 1),
 b AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events WHERE event_type IN ('purchase', 'view') GROUP BY 1)
SELECT coalesce(a.user_id, b.user_id) AS user_id, strftime(a.hi, '%Y-%m-%d %H:%M:%S') AS max_x, strftime(b.hi, '%Y-%m-%d %H:%M:%S') AS max_y, strftime(a.lo, '%Y-%m-%d %H:%M:%S') AS min_x,
 strftime(b.lo, '%Y-%m-%d %H:%M:%S') AS min_y, CASE WHEN a.hi <> b.hi OR a.lo <> b.lo THEN 1 WHEN a.hi = b.hi AND a.lo = b.lo THEN 0 END AS different,
 date_diff('microsecond', b.hi, a.hi) / 86400000000.0 AS max_days_off FROM a FULL JOIN b ON a.user_id = b.user_id""")
def date_drift(t: Tables):
    out = reconcile.date_drift(
        t.events.where("event_type IN ('click', 'view')"), t.events.where("event_type IN ('purchase', 'view')"), ["user_id"], "ts"
    )
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("max_x", "max_y", "min_x", "min_y")})


@query("member_drift", """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""")
def member_drift(t: Tables):
    large = t.orders.where("o_totalprice > 400000").select("o_custkey")
    return reconcile.member_drift(t.customer.select("c_custkey", "c_name", "c_mktsegment"), large, [("c_custkey", "o_custkey")])


@query("user_comparison", """
WITH s AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS users_username, CASE WHEN c_acctbal > 0 THEN 'Yes' WHEN c_acctbal > -500 THEN 'No' END AS users_status,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'SUPPORT' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS users_role, DATE '2021-04-28' + CAST(c_custkey % 20 AS INTEGER) AS added FROM customer),
 g AS (SELECT c_name AS staff_username, 'staff' AS role FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 7 <> 0 UNION ALL SELECT s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'staff' END FROM supplier),
 t AS (SELECT * FROM g WHERE role IS NOT NULL)
SELECT 'created after file' AS finding, users_username AS username, users_role AS role FROM s WHERE added >= DATE '2021-05-07'
UNION ALL SELECT 'not in target', users_username, users_role FROM s WHERE users_status = 'Yes' AND users_role <> 'SUPPORT' AND (users_username IS NULL OR users_username NOT IN ('Customer#000000004', 'Customer#000000006'))
  AND NOT EXISTS (SELECT 1 FROM t WHERE staff_username IS NOT DISTINCT FROM users_username)
UNION ALL SELECT 'not in source', staff_username, role FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE users_username IS NOT DISTINCT FROM staff_username)""")
def user_comparison(t: Tables):
    k, balance, segment = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    source = t.customer.select(
        F.when(k % 10 != 0, F.col("c_name")).alias("users_username"), F.when(balance > 0, "Yes").when(balance > -500, "No").alias("users_status"),
        F.when(segment == "BUILDING", "SUPPORT").when(segment != "MACHINERY", segment).alias("users_role"), F.date_add(dates.day("2021-04-28"), (k % 20).cast("int")).alias("users_audit_date_added"),
    )
    target = t.customer.where("c_custkey % 3 <> 0 AND c_custkey % 7 <> 0").select(F.col("c_name").alias("staff_username"), F.lit("staff").alias("staff_primary_access_role")).unionByName(
        t.supplier.select(F.col("s_name").alias("staff_username"), F.when(F.col("s_suppkey") % 2 == 0, "staff").alias("staff_primary_access_role"))
    )
    out = reconcile.user_comparison(source, target, "2021-05-07", ["Customer#000000004", "Customer#000000006"])
    role = F.coalesce(F.col("attributes")["users_role"], F.col("attributes")["staff_primary_access_role"])
    return out.select("finding", "username", role.alias("role"))


@query("amount_reconcile", """
WITH l AS (SELECT o_orderkey AS id, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS amt FROM orders GROUP BY 1),
 r AS (SELECT l_orderkey AS id, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS amt FROM lineitem GROUP BY 1),
 x AS (SELECT l_orderkey AS id, count(*) AS n, coalesce(sum(CASE WHEN l_discount < 0.05 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END), 0) AS amt FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
 d AS (SELECT l.id, l.n AS n_left, l.amt AS amt_left, r.n - coalesce(x.n, 0) AS n_right, r.amt - coalesce(x.amt, 0) AS amt_right FROM l LEFT JOIN r ON r.id = l.id LEFT JOIN x ON x.id = l.id),
 o AS (SELECT *, abs(amt_right - amt_left) AS diff FROM d WHERE CASE WHEN abs(amt_left - trunc(amt_left)) = 0.5 THEN 2 * round(amt_left / 2) ELSE round(amt_left) END
   <> CASE WHEN abs(amt_right - trunc(amt_right)) = 0.5 THEN 2 * round(amt_right / 2) ELSE round(amt_right) END)
SELECT id AS "EnrollmentID", n_left AS "N_left", CAST(amt_left AS DOUBLE) AS "Amt_left", n_right AS "N_right", CAST(amt_right AS DOUBLE) AS "Amt_right", CAST(diff AS DOUBLE) AS "Amt_diff"
FROM o WHERE diff > (SELECT avg(diff) FROM o)""")
def amount_reconcile(t: Tables):
    left = t.orders.select(F.col("o_orderkey").alias("EnrollmentID"), money("o_totalprice").alias("FAAmount"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("EnrollmentID"), money("l_extendedprice").alias("FAAmount"), "l_returnflag", "l_discount")
    extra = lines.where("l_returnflag = 'R'").select("EnrollmentID", F.when(F.col("l_discount") < 0.05, F.col("FAAmount")).alias("FAAmount"))
    out = reconcile.amount_reconcile(left, lines.select("EnrollmentID", "FAAmount"), extra, "EnrollmentID", "FAAmount")
    return out.withColumns({c: F.col(c).cast("double") for c in ("Amt_left", "Amt_right", "Amt_diff")})


MAPPED_SQL = """WITH m AS (SELECT o_orderkey AS lid, o_orderkey * 10 + i AS rid FROM orders, range(0, 2) r(i) WHERE o_orderkey % 13 <> 0 AND (i = 0 OR o_orderkey % 5 = 0)),
 l AS (SELECT o_orderkey AS lid, rid, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS amt FROM orders LEFT JOIN m ON m.lid = o_orderkey GROUP BY ALL),
 rr AS (SELECT l_orderkey * 10 + CASE WHEN l_orderkey % 5 = 0 THEN l_linenumber % 2 ELSE 0 END AS rid, l_orderkey % 100 AS person, CAST(l_extendedprice AS DECIMAL(12,2)) AS amt FROM lineitem WHERE l_orderkey % 11 <> 0),
 r AS (SELECT lid, rid, count(*) AS n, sum(amt) AS amt FROM rr LEFT JOIN m USING (rid) GROUP BY ALL),
 b AS (SELECT l.lid, l.rid, l.n AS nl, l.amt AS al, r.n AS nr, r.amt AS ar FROM l LEFT JOIN r ON r.lid IS NOT DISTINCT FROM l.lid AND r.rid IS NOT DISTINCT FROM l.rid),
 p AS (SELECT lid, sum(nl) AS nl, sum(al) AS al, CASE WHEN count(nr) = count(*) THEN sum(nr) END AS nr, CASE WHEN count(ar) = count(*) THEN sum(ar) END AS ar FROM b GROUP BY 1),
 x AS (SELECT l_orderkey AS lid, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS amt FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
 d AS (SELECT p.lid, nl, al, nr - coalesce(x.n, 0) AS nr, ar - coalesce(x.amt, 0) AS ar FROM p LEFT JOIN x ON x.lid = p.lid),
 o AS (SELECT d.*, abs(d.ar - d.al) AS diff, b.rid, w.person FROM d JOIN b ON b.lid = d.lid LEFT JOIN (SELECT DISTINCT rid, person FROM rr) w ON w.rid = b.rid WHERE CASE WHEN abs(d.al - trunc(d.al)) = 0.5 THEN 2 * round(d.al / 2) ELSE round(d.al) END
   <> CASE WHEN abs(d.ar - trunc(d.ar)) = 0.5 THEN 2 * round(d.ar / 2) ELSE round(d.ar) END)"""


def mapped(t: Tables):
    """Orders against their lines under other ids; a fifth of the orders have two of them, some none."""
    left = t.orders.select(F.col("o_orderkey").alias("EnrollmentID"), F.col("o_custkey").alias("PersonalID"), money("o_totalprice").alias("FAAmount"))
    twice = F.when(F.col("o_orderkey") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    id_map = t.orders.where("o_orderkey % 13 <> 0").select(F.col("o_orderkey").alias("left_id"), F.explode(twice).alias("i")).select("left_id", (F.col("left_id") * 10 + F.col("i")).alias("right_id"))
    half = F.when(F.col("l_orderkey") % 5 == 0, F.col("l_linenumber") % 2).otherwise(0)
    right = t.lineitem.where("l_orderkey % 11 <> 0").select((F.col("l_orderkey") * 10 + half).alias("EnrollmentID"), (F.col("l_orderkey") % 100).alias("PersonalID"), money("l_extendedprice").alias("FAAmount"))
    extra = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("EnrollmentID"), money("l_extendedprice").alias("FAAmount"))
    return reconcile.mapped_amounts(left, right, extra, id_map)


@query("mapped_amounts", MAPPED_SQL + """
SELECT rid AS right_id, lid AS left_id, CAST(nl AS BIGINT) AS "N_left", CAST(al AS DOUBLE) AS "Amt_left", CAST(nr AS BIGINT) AS "N_right", CAST(ar AS DOUBLE) AS "Amt_right", CAST(diff AS DOUBLE) AS "Amt_diff", person AS right_person
FROM o WHERE diff > (SELECT avg(diff) FROM o)""")
def mapped_amounts(t: Tables):
    return mapped(t)[0].withColumns({c: F.col(c).cast("double") for c in ("Amt_left", "Amt_right", "Amt_diff")})


@query("unmapped_amounts", MAPPED_SQL + """
SELECT lid AS left_id, nl AS "N_left", CAST(al AS DOUBLE) AS "Amt_left", o_custkey AS left_person FROM b JOIN orders ON o_orderkey = lid WHERE rid IS NULL""")
def unmapped_amounts(t: Tables):
    return mapped(t)[1].withColumn("Amt_left", F.col("Amt_left").cast("double"))


def halves(t: Tables):
    """Documents with a label, and those without, by source."""
    docs = t.documents.select("doc_id", "source", "lang", "text")
    labelled = t.labels.select(F.col("doc_id").alias("__label")).where(F.col("__label").isNotNull())
    # Equal with nulls, so that no filter keeps the halves from sharing one exchange of the texts; there is no null to equal.
    same = F.col("doc_id").eqNullSafe(F.col("__label"))
    return docs.join(labelled, same, "left_semi"), docs.join(labelled, same, "left_anti")


HALVES_SQL = f"""a AS (SELECT doc_id, source, lang, {CLEAN_SQL.format('text')} AS note FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
 b AS (SELECT doc_id, source, lang, {CLEAN_SQL.format('text')} AS note FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"""


#: Pattern p (n letters, d edits) in text o: the fewest edits to any of its substrings. Spots and lengths of substrings as a table.
INSIDE_SQL = """SELECT 1 FROM {other} o, range(1, 32) s(i), range(0, 34) l(m) WHERE o.{key} = {own}.{key} AND i <= length(o.{text}) + 1 AND i + m <= length(o.{text}) + 1
  AND abs(m - length({own}.{pattern})) <= ceil(length({own}.{pattern}) / 10.0) AND levenshtein({own}.{pattern}, substr(o.{text}, i, m)) <= ceil(length({own}.{pattern}) / 10.0)"""


@query("fuzzy_prefix", f"""
WITH {HALVES_SQL}, pa AS (SELECT DISTINCT lang, substr(note, 1, 30) AS prefix FROM a), pb AS (SELECT DISTINCT lang, substr(note, 1, 30) AS prefix FROM b)
SELECT lang, prefix FROM pa WHERE NOT EXISTS ({INSIDE_SQL.format(other="pb", own="pa", key="lang", text="prefix", pattern="prefix")})""")
def fuzzy_prefix(t: Tables):
    a, b = (half.select("lang", strip_stopwords(F.col("text")).alias("note")) for half in halves(t))
    return reconcile.fuzzy_prefix(a, b, "lang", "note")


@query("fuzzy_whole_prefix", f"""
WITH {HALVES_SQL}, pa AS (SELECT DISTINCT lang, substr(note, 1, 30) AS prefix FROM a), pb AS (SELECT DISTINCT lang, substr(note, 1, 30) AS prefix FROM b)
SELECT lang, prefix FROM pa WHERE NOT EXISTS (SELECT 1 FROM pb WHERE pb.lang = pa.lang AND levenshtein(pa.prefix, pb.prefix) <= ceil(length(pa.prefix) / 10.0))""")
def fuzzy_whole_prefix(t: Tables):
    a, b = (half.select("lang", strip_stopwords(F.col("text")).alias("note")) for half in halves(t))
    return reconcile.fuzzy_prefix(a, b, "lang", "note", whole=True)


@query("text_reconcile", f"""
WITH {HALVES_SQL}, da AS (SELECT DISTINCT source, note FROM a), db AS (SELECT DISTINCT source, note FROM b),
 oa AS (SELECT *, substr(regexp_replace(note, '[A-Za-z0-9]*com', '', 'g'), 1, 30) AS p FROM (SELECT * FROM da EXCEPT SELECT * FROM db)),
 ob AS (SELECT *, substr(regexp_replace(note, '[A-Za-z0-9]*com', '', 'g'), 1, 30) AS p FROM (SELECT * FROM db EXCEPT SELECT * FROM da)),
 sa AS (SELECT DISTINCT source, substr(note, 1, 30) AS start FROM oa), sb AS (SELECT DISTINCT source, substr(note, 1, 30) AS start FROM ob)
SELECT source, note, 'left' AS side, CASE WHEN EXISTS ({INSIDE_SQL.format(other="sb", own="oa", key="source", text="start", pattern="p")}) THEN 1 ELSE 0 END AS similar FROM oa
UNION ALL SELECT source, note, 'right', CASE WHEN EXISTS ({INSIDE_SQL.format(other="sa", own="ob", key="source", text="start", pattern="p")}) THEN 1 ELSE 0 END FROM ob""".replace(" AS similar", ' AS "similar"'))
def text_reconcile(t: Tables):
    a, b = halves(t)
    return reconcile.text_reconcile(a, b, "source", "text")


@query("code_verify", """
WITH e AS (SELECT n_regionkey, substr(n_name, 1, 8) AS code FROM nation), x AS (SELECT n_regionkey, CASE WHEN n_regionkey = 2 THEN n_name ELSE substr(n_name, 1, 8) END AS code FROM nation WHERE n_nationkey > 1)
SELECT 'expected only' AS side, * FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM x) UNION ALL SELECT 'actual only', * FROM (SELECT * FROM x EXCEPT ALL SELECT * FROM e)""")
def code_verify(t: Tables):
    short = F.substring("n_name", 1, 8)
    expected = t.nation.select("n_regionkey", short.alias("code"))
    actual = t.nation.where("n_nationkey > 1").select("n_regionkey", F.when(F.col("n_regionkey") == 2, F.col("n_name")).otherwise(short).alias("code"))
    return reconcile.code_verify(expected, actual, ["n_regionkey", "code"])


@query("checks", """
SELECT 'no status' AS name, CAST(count(*) FILTER (nullif(o_orderstatus, 'P') IS NULL) = 0 AS INTEGER) AS ok, count(*) FILTER (nullif(o_orderstatus, 'P') IS NULL) AS failing FROM orders
UNION ALL SELECT 'negative price', CAST(count(*) FILTER (o_totalprice < 0) = 0 AS INTEGER), count(*) FILTER (o_totalprice < 0) FROM orders
UNION ALL SELECT 'order key is unique', CAST(count(*) = 0 AS INTEGER), count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1) UNION ALL SELECT 'line is unique', CAST(count(*) = 0 AS INTEGER), count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def checks(t: Tables):
    return reconcile.all_checks(
        reconcile.checks(t.orders, {"no status": nullif("o_orderstatus", "P").isNull(), "negative price": F.col("o_totalprice") < 0}),
        reconcile.unique_check(t.orders, ["o_orderkey"], "order key is unique"),
        reconcile.unique_check(t.lineitem, ["l_orderkey", "l_linenumber"], "line is unique"),
    )


@query("checks_during_write", """
SELECT 'no status' AS name, CAST(count(*) FILTER (nullif(o_orderstatus, 'P') IS NULL) = 0 AS INTEGER) AS ok, count(*) FILTER (nullif(o_orderstatus, 'P') IS NULL) AS failing FROM orders
UNION ALL SELECT 'negative price', CAST(count(*) FILTER (o_totalprice < 0) = 0 AS INTEGER), count(*) FILTER (o_totalprice < 0) FROM orders""")
def checks_during_write(t: Tables):
    bad = {"no status": nullif("o_orderstatus", "P").isNull(), "negative price": F.col("o_totalprice") < 0}
    return guards.checked_write(t.orders, "orders", bad, stop=False)[1]


@query("many_to_many_guard_join", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def many_to_many_guard_join(t: Tables):
    """A join that would stop if a customer had two rows."""
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return guards.guarded_join(t.orders.select("o_orderkey", "o_custkey"), people, "o_custkey", label="customers").drop("o_custkey")


@query("name_drift", """
SELECT c_custkey, c_name AS c_name_x, upper(c_name) AS c_name_y FROM customer WHERE c_mktsegment = 'BUILDING'""")
def name_drift(t: Tables):
    a = t.customer.select("c_custkey", "c_name")
    b = t.customer.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.upper("c_name")).otherwise(F.col("c_name")).alias("c_name"))
    return helpers.name_drift(a, b, ["c_custkey"], "c_name")
