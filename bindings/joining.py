from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bindings.registry import query, table
from sensorloom.operators import combine, filters, joins


@query("range_report_desc", """
SELECT o_orderkey, o_orderdate, o_totalprice, c_name, n_name, r_name
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
WHERE o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
ORDER BY o_orderdate DESC, o_orderkey
""")
def range_report_desc(spark, sf_dir):
    orders = filters.between_exclusive(
        table(spark, sf_dir, "orders"), "o_orderdate", dt.datetime(1996, 1, 1), dt.datetime(1998, 1, 1))
    rows = joins.star_join(orders.withColumnRenamed("o_custkey", "c_custkey"), [
        (table(spark, sf_dir, "customer"), "c_custkey"),
        (table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"),
        (table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"),
    ])
    return combine.newest_first(rows, "o_orderdate", ["o_orderkey"]).select(
        "o_orderkey", "o_orderdate", "o_totalprice", "c_name", "n_name", "r_name")


@query("star_report", """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, p_name, p_type, s_name, n_name
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey
ORDER BY l_shipdate DESC
""")
def star_report(spark, sf_dir):
    rows = joins.star_join(
        table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_partkey": "p_partkey", "l_suppkey": "s_suppkey"}), [
            (table(spark, sf_dir, "part"), "p_partkey"),
            (table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey"), "s_suppkey"),
            (table(spark, sf_dir, "nation"), "n_nationkey"),
        ])
    return combine.newest_first(rows, "l_shipdate", ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "p_name", "p_type", "s_name", "n_name")


@query("parameter_report", """
SELECT p_name, s_name, o_orderpriority, l_quantity, o_orderdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
     JOIN supplier ON l_suppkey = s_suppkey
WHERE p_brand = 'Brand#7' AND o_orderdate > TIMESTAMP '1996-06-01' AND o_orderdate < TIMESTAMP '2000-06-01'
ORDER BY o_orderdate DESC
""")
def parameter_report(spark, sf_dir):
    lines = joins.star_join(
        table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"),
            F.col("l_suppkey").alias("s_suppkey"), "l_quantity"), [
            (filters.matching(table(spark, sf_dir, "part"), {"p_brand": "Brand#7", "p_type": None}), "p_partkey"),
            (table(spark, sf_dir, "supplier"), "s_suppkey"),
        ])
    orders = filters.between_exclusive(
        table(spark, sf_dir, "orders"), "o_orderdate", dt.datetime(1996, 6, 1), dt.datetime(2000, 6, 1))
    rows = lines.join(orders, "o_orderkey")
    return combine.newest_first(rows, "o_orderdate", ["o_orderkey"]).select(
        "p_name", "s_name", "o_orderpriority", "l_quantity", "o_orderdate")


@query("top_1000", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem
ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice LIMIT 1000
""")
def top_1000(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = table(spark, sf_dir, "lineitem").select(*columns, "l_shipdate")
    return combine.newest(rows, 1000, "l_shipdate", columns)


@query("distinct_catalogue", """
SELECT DISTINCT l_suppkey, p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def distinct_catalogue(spark, sf_dir):
    seen = combine.distinct_rows(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey"])
    rows = joins.star_join(
        seen.withColumnRenamed("l_partkey", "p_partkey"), [(table(spark, sf_dir, "part"), "p_partkey")])
    return combine.distinct_rows(rows, ["l_suppkey", "p_brand", "p_type"])


@query("lookup_left", """
SELECT o_orderkey, o_custkey, c.c_name, c.c_mktsegment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey
""")
def lookup_left(spark, sf_dir):
    known = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.left_enrich(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), known, ["o_custkey"])


@query("lookup_null_safe", """
SELECT o.o_orderkey, o.k AS gateway, d.n_name
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN cast(left(o_orderpriority, 1) AS integer) END AS k
      FROM orders) o
LEFT JOIN (SELECT CASE WHEN n_nationkey > 0 THEN n_nationkey END AS k, n_name FROM nation) d
  ON o.k IS NOT DISTINCT FROM d.k
""")
def lookup_null_safe(spark, sf_dir):
    priority = F.left("o_orderpriority", F.lit(1)).cast("int")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", priority).alias("gateway"))
    details = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_nationkey") > 0, F.col("n_nationkey")).alias("gateway"), "n_name")
    return joins.left_enrich(rows, details, ["gateway"], null_safe=True)


@query("lookup_unique", """
SELECT c_custkey, (SELECT min(o_orderpriority) FROM orders WHERE o_custkey = c_custkey) AS o_orderpriority
FROM customer
""")
def lookup_unique(spark, sf_dir):
    lookup = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    return joins.left_lookup(
        table(spark, sf_dir, "customer").select("c_custkey"), lookup, ["c_custkey"], ["o_orderpriority"])


@query("lookup_conflicts", """
SELECT o_custkey, count(DISTINCT o_orderpriority) AS candidates FROM orders GROUP BY 1
HAVING count(DISTINCT o_orderpriority) > 1
""")
def lookup_conflicts(spark, sf_dir):
    return joins.lookup_conflicts(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderpriority"])


@query("allow_list", """
SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def allow_list(spark, sf_dir):
    registry = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return joins.known_only(
        table(spark, sf_dir, "events").select("event_id", "user_id"), registry, "user_id", "c_custkey")


@query("unknown_devices", """
SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def unknown_devices(spark, sf_dir):
    registry = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return joins.unknown_only(
        table(spark, sf_dir, "events").select("event_id", "user_id"), registry, "user_id", "c_custkey")


def many_parent_updates(spark, sf_dir):
    """Order dates and ship dates in one table with a key column per kind of parent."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.lit(None).cast("bigint").alias("line_key"),
        F.col("o_orderdate").alias("last_update"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", F.col("l_orderkey")).alias("order_key"),
        F.when(F.col("l_returnflag") != "A", F.col("l_partkey")).alias("line_key"),
        F.col("l_shipdate").alias("last_update"))
    return orders.unionByName(lines)


UPDATES_SQL = """
  SELECT o_orderkey AS order_key, NULL::bigint AS line_key, o_orderdate AS last_update FROM orders
  UNION ALL
  SELECT CASE WHEN l_linestatus = 'F' THEN l_orderkey END, CASE WHEN l_returnflag <> 'A' THEN l_partkey END,
         l_shipdate FROM lineitem
"""


@query("polymorphic_updates", f"""
WITH updates AS ({UPDATES_SQL})
SELECT 'order' AS kind, o_orderkey AS parent, o_orderstatus AS detail, last_update
FROM orders JOIN updates ON o_orderkey = order_key
UNION ALL
SELECT 'line', p_partkey, p_name, last_update FROM part JOIN updates ON p_partkey = line_key
""")
def polymorphic_updates(spark, sf_dir):
    """Both kinds of parents, each with its own rows of the one timestamp table."""
    updates = many_parent_updates(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("detail"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("line_key"), F.col("p_name").alias("detail"))
    found = [
        joins.with_parent_timestamp(parents, updates, key, "last_update").select(
            F.lit(kind).alias("kind"), F.col(key).alias("parent"), "detail", "last_update")
        for kind, parents, key in (("order", orders, "order_key"), ("line", parts, "line_key"))]
    return combine.append_by_name(*found)


@query("like_lookup", """
WITH asked AS (
  SELECT DISTINCT CASE WHEN p_size > 40 THEN left(p_name, 3) || '%' WHEN p_size > 30 THEN '%' || right(p_name, 4)
                       WHEN p_size > 20 THEN replace(p_name, ' ', '_') WHEN p_size > 10 THEN p_name || '!'
                       ELSE p_name END AS pattern FROM part)
SELECT pattern, min(p_name) AS p_name FROM asked JOIN (SELECT DISTINCT p_name FROM part) ON p_name LIKE pattern
GROUP BY pattern
""")
def like_lookup(spark, sf_dir):
    size, name = F.col("p_size"), F.col("p_name")
    pattern = (
        F.when(size > 40, F.concat(F.left(name, F.lit(3)), F.lit("%")))
        .when(size > 30, F.concat(F.lit("%"), F.right(name, F.lit(4))))
        .when(size > 20, F.translate(name, " ", "_"))
        .when(size > 10, F.concat(name, F.lit("!")))
        .otherwise(name))
    part = table(spark, sf_dir, "part")
    return joins.like_lookup(part.select(pattern.alias("pattern")), part, "pattern", "p_name")
