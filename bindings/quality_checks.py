from __future__ import annotations

from pyspark.sql import functions as F

from bindings.joining import UPDATES_SQL, many_parent_updates
from bindings.registry import guid, query, table
from sensorloom.functions.keys import surrogate_key
from sensorloom.operators import quality


@query("pk_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def pk_violations(spark, sf_dir):
    return quality.pk_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("fk_orphans", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
""")
def fk_orphans(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'")
    children = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return quality.fk_orphans(children, parents, ["o_custkey"], ["c_custkey"])


@query("null_violations", """
SELECT "ID", "AI3", "AI4" FROM (
  SELECT l_orderkey AS "ID", nullif(l_discount, 0) AS "AI3", nullif(l_tax, 0) AS "AI4" FROM lineitem)
WHERE "AI3" IS NULL OR "AI4" IS NULL
""")
def null_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ID"), F.nullif("l_discount", F.lit(0.0)).alias("AI3"),
        F.nullif("l_tax", F.lit(0.0)).alias("AI4"))
    return quality.null_violations(rows, ["AI3", "AI4"])


@query("length_violations", """
SELECT p_partkey, p_name, p_brand FROM part WHERE length(p_name) > 10 OR length(p_brand) > 7
""")
def length_violations(spark, sf_dir):
    return quality.length_violations(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), {"p_name": 10, "p_brand": 7})


@query("cut_to_length", "SELECT p_partkey, left(p_name, 10) AS p_name, left(p_brand, 1) AS p_brand FROM part")
def cut_to_length(spark, sf_dir):
    return quality.cut_to_length(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), {"p_name": 10, "p_brand": 1})


@query("id_format_violations", """
SELECT o_orderkey, o_orderpriority AS id FROM orders WHERE o_orderstatus = 'P'
""")
def id_format_violations(spark, sf_dir):
    status = F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "P", F.col("o_orderpriority")).when(status == "F", surrogate_key("order", "o_orderkey"))
        .alias("id"))
    return quality.id_format_violations(rows, ["id"])


@query("parent_count_violations", f"""
SELECT * FROM ({UPDATES_SQL})
WHERE (order_key IS NOT NULL)::int + (line_key IS NOT NULL)::int <> 1
""")
def parent_count_violations(spark, sf_dir):
    return quality.parent_count_violations(many_parent_updates(spark, sf_dir), ["order_key", "line_key"])


@query("column_report", """
SELECT count(*) AS row_count, count(*) FILTER (nullif(l_discount, 0) IS NULL) AS "null_l_discount",
       count(*) FILTER (length(l_returnflag || l_orderkey) > 4) AS "long_flag"
FROM lineitem
""")
def column_report(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.concat("l_returnflag", F.col("l_orderkey").cast("string")).alias("flag"))
    return quality.column_report(rows, ["l_discount"], {"flag": 4})
