from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from bindings.views import MESSAGES_SQL, WIDE_SQL, messages, wide_channels
from sensorloom.operators import reshape
from sensorloom.plans.uplink import payload_readings
from sensorloom.sources.schemas import LEGACY_FIELDS

DELIMITERS = ["%7c", "|"]


@query("parallel_split", f"""
WITH msg AS ({MESSAGES_SQL}),
     cut AS (SELECT *, string_split_regex("rawData", '%7c|\\|') AS a, string_split_regex("dataValue", '%7c|\\|') AS b,
                    string_split_regex("plotLabels", '%7c|\\|') AS c, string_split_regex("plotValues", '%7c|\\|') AS d
             FROM msg),
     numbered AS (SELECT *, unnest(range(greatest(len(a), len(b), len(c), len(d)))) AS i FROM cut)
SELECT "dataMessageGUID", "sensorName", cast(i AS integer) AS pos,
       coalesce(a[i + 1], '') AS "rawData", coalesce(b[i + 1], '') AS "dataValue",
       coalesce(c[i + 1], '') AS "plotLabels", coalesce(d[i + 1], '') AS "plotValues"
FROM numbered
""")
def parallel_split(spark, sf_dir):
    columns = ["rawData", "dataValue", "plotLabels", "plotValues"]
    rows = messages(spark, sf_dir).select("dataMessageGUID", "sensorName", *columns)
    return reshape.split_parallel(rows, columns, DELIMITERS, position="pos")


@query("parallel_split_rejoin", f"""
WITH msg AS ({MESSAGES_SQL})
SELECT "sensorName", cast(sum(len(string_split("rawData", '%7c'))) AS bigint) AS parts, count(*) AS messages FROM msg GROUP BY 1
""")
def parallel_split_rejoin(spark, sf_dir):
    """Row counts of the split, per sensor, without a position column."""
    rows = reshape.split_parallel(
        messages(spark, sf_dir).select("dataMessageGUID", "sensorName", "rawData"), ["rawData"], DELIMITERS)
    per_message = rows.groupBy("sensorName", "dataMessageGUID").agg(F.count("*").alias("parts"))
    return per_message.groupBy("sensorName").agg(F.sum("parts").alias("parts"), F.count("*").alias("messages"))


@query("unpivot_channels", f"""
WITH wide AS ({WIDE_SQL})
SELECT "ID", "INTERFACE_ID", "DATETIME", l_linenumber, cast(ltrim(n, 'AI') AS bigint) AS aid, v AS value
FROM (FROM wide UNPIVOT INCLUDE NULLS (v FOR n IN ("AI1", "AI2", "AI3", "AI4")))
""")
def unpivot_channels(spark, sf_dir):
    ids = ["ID", "INTERFACE_ID", "DATETIME", "l_linenumber"]
    return reshape.number_channels(reshape.unpivot_channels(wide_channels(spark, sf_dir), ids))


@query("pivot_channels", """
SELECT user_id, avg(value) FILTER (event_type = 'click') AS click, avg(value) FILTER (event_type = 'error') AS error,
       avg(value) FILTER (event_type = 'purchase') AS purchase, avg(value) FILTER (event_type = 'signup') AS signup,
       avg(value) FILTER (event_type = 'view') AS view
FROM (SELECT user_id, event_type, round(value * 100) AS value FROM events) GROUP BY user_id
""")
def pivot_channels(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.round(F.col("value") * 100).alias("value"))
    return reshape.pivot_channels(rows, ["user_id"], "event_type", "value", ["click", "error", "purchase", "signup", "view"])


# orders as documents: names and values as parallel lists, fewer names than values, and receivers.
_ORDER_NAMES = ("custkey", "status", "priority")


def _documents(spark, sf_dir):
    status = F.col("o_orderstatus")
    count = F.when(status == "P", 1).when(status == "F", 2).otherwise(3)
    names = F.slice(F.array(*[F.lit(name) for name in _ORDER_NAMES]), F.lit(1), count)
    values = F.array(F.col("o_custkey").cast("string"), status, F.col("o_orderpriority"))
    readings = F.struct(
        F.when(status != "O", names).alias("sensor_names"), F.when(status != "O", values).alias("sensor_data"),
        *[F.when((status == "O") & F.lit(field in ("altitude", "temp")), F.col("o_custkey").cast("string"))
          .alias(field) for field in LEGACY_FIELDS])
    receivers = F.slice(F.array(*[
        F.struct(F.lit(f"gw-{index}").alias("gateway"), (F.col("o_custkey") + index).alias("rssi"))
        for index in range(3)
    ]), F.lit(1), F.when(status == "P", 0).otherwise(count))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", status.alias("status"), names.alias("names"), values.alias("values"),
        readings.alias("payload"), receivers.alias("receivers"))


_DOCUMENTS_SQL = """
  SELECT o_orderkey, o_custkey, o_orderstatus AS status,
         (CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 3 END) AS n,
         ['custkey', 'status', 'priority'] AS names,
         [cast(o_custkey AS varchar), o_orderstatus, o_orderpriority] AS vals
  FROM orders
"""


@query("zip_names_values", f"""
WITH doc AS ({_DOCUMENTS_SQL}), numbered AS (SELECT *, unnest(range(n)) AS i FROM doc)
SELECT o_orderkey, names[i + 1] AS name, vals[i + 1] AS value FROM numbered
""")
def zip_names_values(spark, sf_dir):
    pairs = reshape.zip_names_values(F.col("names"), F.col("values"))
    return _documents(spark, sf_dir).select("o_orderkey", F.inline(pairs))


@query("legacy_fields", """
SELECT o_orderkey, unnest(['Order', 'Customer', 'Status']) AS name,
       unnest([cast(o_orderkey AS varchar), cast(o_custkey AS varchar), o_orderstatus]) AS value
FROM orders
""")
def legacy_fields(spark, sf_dir):
    labels = {"o_orderkey": "Order", "o_custkey": "Customer", "o_orderstatus": "Status"}
    payload = F.struct(*labels)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.inline(reshape.labelled_fields(labels, payload)))


@query("payload_dispatch", f"""
WITH doc AS ({_DOCUMENTS_SQL}),
     numbered AS (SELECT *, unnest(range(n)) AS i FROM doc WHERE status <> 'O')
SELECT o_orderkey, names[i + 1] AS name, vals[i + 1] AS value FROM numbered
UNION ALL
SELECT o_orderkey, unnest(['Altitude', 'Temperature']), cast(o_custkey AS varchar) FROM doc WHERE status = 'O'
""")
def payload_dispatch(spark, sf_dir):
    return _documents(spark, sf_dir).select("o_orderkey", F.inline(payload_readings(F.col("payload"))))


@query("explode_children", f"""
WITH doc AS ({_DOCUMENTS_SQL}),
     numbered AS (SELECT *, unnest(range(n)) AS i FROM doc WHERE status <> 'P')
SELECT o_orderkey, cast(i AS integer) AS pos, 'gw-' || i AS gateway, o_custkey + i AS rssi FROM numbered
UNION ALL
SELECT o_orderkey, NULL, NULL, NULL FROM doc WHERE status = 'P'
""")
def explode_children(spark, sf_dir):
    rows = reshape.explode_children(
        _documents(spark, sf_dir).select("o_orderkey", "receivers"), "receivers", keep_empty=True)
    return rows.select("o_orderkey", "pos", "item.gateway", "item.rssi")


@query("positional_pick", f"""
WITH doc AS ({_DOCUMENTS_SQL})
SELECT o_orderkey, CASE WHEN status <> 'P' THEN o_custkey END AS first_rssi,
       CASE WHEN status <> 'P' THEN 'gw-1' END AS last_gateway
FROM doc
""")
def positional_pick(spark, sf_dir):
    receivers = F.col("receivers")
    usable = reshape.last_where(receivers, lambda rx: rx.getField("gateway") != "gw-2")
    return _documents(spark, sf_dir).select(
        "o_orderkey",
        reshape.first_of(receivers).getField("rssi").alias("first_rssi"),
        usable.getField("gateway").alias("last_gateway"))


@query("flatten_nested", """
SELECT o_orderkey AS "id", o_custkey AS "who.key", o_orderstatus AS "what.state.code",
       o_orderpriority AS "what.state.rank", o_orderdate AS "what.day"
FROM orders
""")
def flatten_nested(spark, sf_dir):
    nested = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("key")).alias("who"),
        F.struct(
            F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("rank")).alias("state"),
            F.col("o_orderdate").alias("day")).alias("what"))
    return reshape.flatten_nested(nested)
