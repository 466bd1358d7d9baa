"""Aggregation, windows, set operations and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups, reshape
from .base import Tables, money, nullif, query


@query("group_profile", """
SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day,
 CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_orders, max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent
FROM orders GROUP BY 1""")
def group_profile(t: Tables):
    profile = groups.group_profile(t.orders, ["o_custkey"], {
        "first_day": F.min("o_orderdate"), "last_day": F.max("o_orderdate"),
        "open_orders": F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)),
        "urgent": F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)),
    })
    return profile.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_day", "last_day")})


@query("count_by", "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def count_by(t: Tables):
    return groups.count_by(t.orders, ["o_orderpriority", "o_orderstatus"])


@query("count_amount", """
SELECT o_custkey, count(*) AS "N", CAST(coalesce(sum(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(12,2)) END), 0) AS DOUBLE) AS "Amt" FROM orders GROUP BY 1""")
def count_amount(t: Tables):
    rows = t.orders.select("o_custkey", F.when(F.col("o_orderstatus") != "P", money("o_totalprice")).alias("amount"))
    return groups.count_amount(rows, ["o_custkey"], "amount").withColumn("Amt", F.col("Amt").cast("double"))


@query("conditional_counts", """
SELECT count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus = 'O' AND o_totalprice > 100000) AS open_large,
 count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(*) AS rows FROM orders""")
def conditional_counts(t: Tables):
    is_open = F.col("o_orderstatus") == "O"
    return groups.conditional_counts(t.orders, {
        "open": is_open, "open_large": is_open & (F.col("o_totalprice") > 100000),
        "urgent": F.col("o_orderpriority") == "1-URGENT", "rows": F.lit(True),
    })


@query("group_minmax_dates", """
SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_any, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS min_any,
 strftime(max(CASE WHEN event_type = 'click' THEN ts END), '%Y-%m-%d %H:%M:%S') AS max_click,
 strftime(min(CASE WHEN event_type = 'click' THEN ts END), '%Y-%m-%d %H:%M:%S') AS min_click FROM events GROUP BY 1""")
def group_minmax_dates(t: Tables):
    e = t.events.select("user_id", "ts", F.when(F.col("event_type") == "click", F.col("ts")).alias("clicked"))
    out = groups.group_minmax_dates(e, ["user_id"], {"any": "ts", "click": "clicked"})
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in out.columns if c != "user_id"})


@query("list_agg", """
SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY CAST(l_partkey AS VARCHAR)) AS parts FROM lineitem GROUP BY 1""")
def list_agg(t: Tables):
    return groups.list_agg(t.lineitem, ["l_orderkey"], "l_partkey", "parts", "n")


@query("nth_columns", """
WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS i FROM lineitem)
SELECT l_orderkey, count(*) AS n, """ + ", ".join(f"coalesce(max(CASE WHEN i = {i} THEN CAST(l_partkey AS VARCHAR) END), '') AS part{i}" for i in range(1, 9)) + """
FROM r GROUP BY 1""")
def nth_columns(t: Tables):
    return groups.nth_columns(t.lineitem, ["l_orderkey"], "l_partkey", 8, "part", "n")


@query("duplicate_groups", """
SELECT p_partkey, p_name, p_brand, n AS dupe_count FROM (SELECT p_partkey, p_name, p_brand, count(*) OVER (PARTITION BY p_name, p_brand) AS n FROM part) WHERE n > 1""")
def duplicate_groups(t: Tables):
    return groups.duplicate_groups(t.part.select("p_partkey", "p_name", "p_brand"), ["p_name", "p_brand"])


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables):
    return t.lineitem.select("l_partkey", "l_returnflag", "l_linestatus").distinct()


@query("distinct_keep_first", """
SELECT p_partkey, p_name, p_brand, p_type, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_size, p_partkey) AS i FROM part) WHERE i = 1""")
def distinct_keep_first(t: Tables):
    parts = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return groups.distinct_keep_first(parts, ["p_name", "p_brand"], ["p_size", "p_partkey"])


@query("above_mean", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)")
def above_mean(t: Tables):
    return groups.above_mean(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice")


@query("latest_ties", """
WITH e AS (SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day, date_trunc('hour', ts) AS hour, event_type FROM events)
SELECT event_id, user_id, day, event_type FROM (SELECT *, rank() OVER (PARTITION BY user_id, day ORDER BY hour DESC) AS r FROM e) WHERE r = 1""")
def latest_ties(t: Tables):
    e = t.events.select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_trunc("hour", "ts").alias("hour"), "event_type")
    return groups.latest(e, ["user_id", "day"], "hour").drop("hour")


@query("latest_two_level", """
WITH e AS (SELECT event_id, user_id, event_type, date_trunc('day', ts) AS day, CASE WHEN value > 5 THEN date_trunc('hour', ts) END AS hour FROM events)
SELECT event_id, user_id, event_type FROM (SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY day DESC NULLS LAST, hour DESC NULLS LAST) AS r FROM e) WHERE r = 1""")
def latest_two_level(t: Tables):
    e = t.events.select(
        "event_id", "user_id", "event_type", F.date_trunc("day", "ts").alias("day"),
        F.when(F.col("value") > 5, F.date_trunc("hour", "ts")).alias("hour"),
    )
    return groups.latest(e, ["user_id", "event_type"], ["day", "hour"]).drop("day", "hour")


@query("earliest_owner", """
SELECT l_partkey, l_suppkey, l_orderkey FROM (SELECT *, rank() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS r FROM lineitem) WHERE r = 1""")
def earliest_owner(t: Tables):
    return groups.latest(t.lineitem.select("l_partkey", "l_suppkey", "l_orderkey"), ["l_partkey"], "l_suppkey", ascending=True)


@query("global_min_row", "SELECT p_partkey, p_name, p_size FROM part ORDER BY length(p_name), p_size, p_partkey LIMIT 1")
def global_min_row(t: Tables):
    parts = t.part.select("p_partkey", "p_name", "p_size", F.char_length("p_name").alias("len"))
    return groups.global_min_row(parts, ["len", "p_size", "p_partkey"]).drop("len")


@query("group_broadcast_min", """
SELECT o_orderkey, o_custkey, strftime(min(o_orderdate) OVER (PARTITION BY o_custkey), '%Y-%m-%d') AS first_day FROM orders""")
def group_broadcast_min(t: Tables):
    out = groups.with_group(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], {"first_day": F.min("o_orderdate")})
    return out.select("o_orderkey", "o_custkey", F.date_format("first_day", "yyyy-MM-dd").alias("first_day"))


@query("seq_in_group", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders""")
def seq_in_group(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    month = F.date_trunc("month", "o_orderdate")
    return groups.seq_in_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], slice_by=month).drop("o_orderdate")


@query("seq_in_large_group", """
SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY date_trunc('year', l_shipdate), l_orderkey, l_linenumber) AS n FROM lineitem""")
def seq_in_large_group(t: Tables):
    """Three groups, each with a heap of rows at one moment."""
    lines = t.lineitem.select("l_returnflag", F.date_trunc("year", "l_shipdate").alias("year"), "l_orderkey", "l_linenumber")
    return groups.seq_in_group(lines, ["l_returnflag"], ["year", "l_orderkey", "l_linenumber"], unique=True).drop("year")


@query("surrogate_id", "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey, o_custkey FROM orders")
def surrogate_id(t: Tables):
    return groups.surrogate_id(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "id", unique=True).drop("o_orderdate")


@query("sort_rows", "SELECT p_partkey, nullif(p_brand, 'Brand#1') AS brand, p_name FROM part ORDER BY brand NULLS LAST, p_name, p_partkey")
def sort_rows(t: Tables):
    return reshape.sort_rows(t.part.select("p_partkey", nullif("p_brand", "Brand#1").alias("brand"), "p_name"), "brand", "p_name", "p_partkey")


@query("union_by_name", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_nationkey AS nation FROM customer
UNION ALL SELECT s_name, s_name, s_nationkey FROM supplier""")
def union_by_name(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    firms = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), F.col("s_name").alias("id"))
    return reshape.union_by_name(people, firms)


@query("union_sparse", """
SELECT 'order' AS kind, o_custkey AS person, o_orderpriority AS priority, NULL AS event_type, NULL AS segment FROM orders
UNION ALL SELECT 'event', user_id, NULL, event_type, NULL FROM events UNION ALL SELECT 'customer', c_custkey, NULL, NULL, c_mktsegment FROM customer""")
def union_sparse(t: Tables):
    return reshape.union_sparse(
        t.orders.select(F.lit("order").alias("kind"), F.col("o_custkey").alias("person"), F.col("o_orderpriority").alias("priority")),
        t.events.select(F.lit("event").alias("kind"), F.col("user_id").alias("person"), "event_type"),
        t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("person"), F.col("c_mktsegment").alias("segment")),
    )


def snapshots(t: Tables):
    """The customers, and the same after some were dropped, some added and some changed."""
    before = t.customer.select("c_custkey", "c_name", nullif("c_nationkey", 4).alias("nation"), "c_mktsegment")
    after = before.where("c_name NOT LIKE '%7'").select(
        "c_custkey", F.when(F.col("c_name").endswith("33"), F.upper("c_name")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.coalesce("nation", F.lit(4))).otherwise(F.col("nation")).alias("nation"),
        F.when(F.col("c_name").endswith("5"), F.lit("OTHER")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    added = t.supplier.select(
        (F.col("s_suppkey") + 10_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("nation"), F.lit("NEW").alias("c_mktsegment"),
    )
    return before, after.unionByName(added)


SNAPSHOT_SQL = """before AS (SELECT c_custkey, c_name, nullif(c_nationkey, 4) AS nation, c_mktsegment FROM customer),
 after AS (SELECT c_custkey, CASE WHEN c_name LIKE '%33' THEN upper(c_name) ELSE c_name END AS c_name,
   CASE WHEN c_mktsegment = 'BUILDING' THEN coalesce(nation, 4) ELSE nation END AS nation,
   CASE WHEN c_name LIKE '%5' THEN 'OTHER' ELSE c_mktsegment END AS c_mktsegment FROM before WHERE c_name NOT LIKE '%7'
  UNION ALL SELECT s_suppkey + 10000000, s_name, s_nationkey, 'NEW' FROM supplier)"""


@query("key_setdiff", f"""
WITH {SNAPSHOT_SQL} SELECT 'removed' AS side, * FROM before b WHERE NOT EXISTS (SELECT 1 FROM after a
   WHERE a.c_custkey = b.c_custkey AND a.nation IS NOT DISTINCT FROM b.nation AND a.c_mktsegment = b.c_mktsegment)
UNION ALL SELECT 'added', * FROM after a WHERE NOT EXISTS (SELECT 1 FROM before b
   WHERE a.c_custkey = b.c_custkey AND a.nation IS NOT DISTINCT FROM b.nation AND a.c_mktsegment = b.c_mktsegment)""")
def key_setdiff(t: Tables):
    removed, added = reshape.key_diff(*snapshots(t), ["c_custkey", "nation", "c_mktsegment"])
    return removed.withColumn("side", F.lit("removed")).unionByName(added.withColumn("side", F.lit("added")))


@query("row_setdiff", f"WITH {SNAPSHOT_SQL} SELECT nation, c_mktsegment, c_name FROM before EXCEPT SELECT nation, c_mktsegment, c_name FROM after")
def row_setdiff(t: Tables):
    before, after = snapshots(t)
    return reshape.row_diff(before, after, ["nation", "c_mktsegment", "c_name"])


@query("id_intersect", "SELECT DISTINCT user_id AS id FROM events INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def id_intersect(t: Tables):
    large = t.orders.where("o_totalprice > 300000").select(F.col("o_custkey").alias("id"))
    return reshape.id_intersect(t.events.select(F.col("user_id").alias("id")), large, "id")


@query("unite", "SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#1'), 'NA') || '_' || p_type || '_' || p_size AS kind, p_name FROM part")
def unite(t: Tables):
    parts = t.part.select("p_partkey", nullif("p_brand", "Brand#1").alias("p_brand"), "p_type", "p_size", "p_name")
    return reshape.unite(parts, "kind", ["p_brand", "p_type", "p_size"])


@query("separate", """
SELECT p_partkey, string_split(txt, ',')[1] AS last, string_split(txt, ',')[2] AS first FROM
 (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN p_brand WHEN 'SMALL' THEN p_brand || ', ' || p_name || ', Jr' ELSE p_brand || ', ' || p_name END AS txt FROM part)""")
def separate(t: Tables):
    both = F.concat("p_brand", F.lit(", "), "p_name")
    txt = F.when(F.col("p_type") == "PROMO", F.col("p_brand")).when(F.col("p_type") == "SMALL", F.concat(both, F.lit(", Jr"))).otherwise(both)
    return reshape.separate(t.part.select("p_partkey", txt.alias("txt")), "txt", ["last", "first"], ",")


TYPES = ("click", "error", "purchase", "signup", "view")


@query("eav_pivot", "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, " + ", ".join(
    f"max(CASE WHEN event_type = '{e}' THEN value END) AS c_{e}" for e in TYPES) + " FROM events GROUP BY 1, 2")
def eav_pivot(t: Tables):
    e = t.events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value")
    return reshape.eav_pivot(e, ["user_id", "day"], "event_type", "value", {x: f"c_{x}" for x in TYPES})


@query("latest_pivot", "WITH e AS (SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('day', ts) DESC) AS r FROM events) SELECT user_id, " + ", ".join(
    f"max(CASE WHEN event_type = '{e}' AND r = 1 THEN value END) AS c_{e}" for e in TYPES) + " FROM e GROUP BY 1")
def latest_pivot(t: Tables):
    e = t.events.select("user_id", F.date_trunc("day", "ts").alias("day"), "event_type", "value")
    return reshape.latest_pivot(e, ["user_id"], ["day"], "event_type", "value", {x: f"c_{x}" for x in TYPES})


@query("duplicate_cells", """
SELECT user_id, event_type, count(DISTINCT value) AS "values" FROM events GROUP BY 1, 2 HAVING count(DISTINCT value) > 1""")
def duplicate_cells(t: Tables):
    return reshape.duplicate_cells(t.events, ["user_id"], "event_type", "value")


@query("spread_numbered", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders) SELECT o_custkey, " + ", ".join(
    f"max(CASE WHEN i = {i} THEN {c} END) AS {c}_{i}" for c in ("o_orderkey", "o_orderpriority", "o_totalprice") for i in (1, 2, 3)) + " FROM r GROUP BY 1")
def spread_numbered(t: Tables):
    return reshape.spread_numbered(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderpriority", "o_totalprice"], 3)


@query("unnest_diff", """
SELECT DISTINCT o_custkey, o_orderpriority AS item FROM orders o WHERE o_orderstatus = 'F'
 AND NOT EXISTS (SELECT 1 FROM orders q WHERE q.o_custkey = o.o_custkey AND q.o_orderstatus = 'O' AND q.o_orderpriority = o.o_orderpriority)""")
def unnest_diff(t: Tables):
    def priorities(status):
        return F.collect_set(F.when(F.col("o_orderstatus") == status, F.col("o_orderpriority")))

    lists = t.orders.groupBy("o_custkey").agg(priorities("F").alias("closed"), priorities("O").alias("open"))
    return reshape.unnest_diff(lists, "closed", "open")
