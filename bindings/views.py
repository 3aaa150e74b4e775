"""Sensor-shaped views of the given tables, once for Spark and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bindings.registry import table

# events as sensor messages: three raw parts, two value parts, one plot value.
MESSAGES_SQL = """
  SELECT cast(event_id AS varchar) AS "dataMessageGUID",
         event_type || ' ' || user_id AS "sensorName",
         cast(user_id AS integer) AS "networkID",
         cast(length(event_type) AS integer) AS "applicationID",
         event_id || '%7c' || user_id || '%7c' || regexp_extract(props, '([0-9]+)', 1) AS "rawData",
         event_id || '|' || user_id AS "dataValue",
         event_type || '|' || user_id AS "dataType",
         event_type || '|' || user_id AS "plotLabels",
         regexp_extract(props, '([0-9]+)', 1) AS "plotValues",
         ts AS "messageDate",
         value AS "signalStrength",
         value / 2 AS "voltage",
         cast(regexp_extract(props, '([0-9]+)', 1) AS integer) AS "batteryLevel",
         CASE event_type WHEN 'error' THEN 'True' WHEN 'view' THEN 'False' END AS "pendingChange"
  FROM events
"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(table(spark, sf_dir, "events"))


def as_messages(events: DataFrame) -> DataFrame:
    user = F.col("user_id").cast("string")
    event = F.col("event_id").cast("string")
    level = F.regexp_extract("props", "([0-9]+)", 1)
    return events.select(
        event.alias("dataMessageGUID"),
        F.concat_ws(" ", "event_type", user).alias("sensorName"),
        F.col("user_id").cast("int").alias("networkID"),
        F.length("event_type").alias("applicationID"),
        F.concat_ws("%7c", event, user, level).alias("rawData"),
        F.concat_ws("|", event, user).alias("dataValue"),
        F.concat_ws("|", "event_type", user).alias("dataType"),
        F.concat_ws("|", "event_type", user).alias("plotLabels"),
        level.alias("plotValues"),
        F.col("ts").alias("messageDate"),
        F.col("value").alias("signalStrength"),
        (F.col("value") / 2).alias("voltage"),
        level.cast("int").alias("batteryLevel"),
        F.when(F.col("event_type") == "error", "True").when(F.col("event_type") == "view", "False")
        .alias("pendingChange"),
    )


# events as particulate messages: clicks and views carry the particulate label, purchases have too
# few raw parts, errors only the three-part type.
PARTICULATE_SQL = """
  SELECT event_id,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN '?g/m^3|PM1|PM2.5|PM10' ELSE event_type END
           AS "plotLabels",
         CASE WHEN event_type = 'purchase' THEN cast(event_id AS varchar)
              WHEN event_type = 'view' THEN event_id || '%7c' || user_id || '%7c3%7c4'
              ELSE event_id || '%7c' || user_id || '%7c3' END AS "rawData",
         event_id || '|' || user_id || '|3' AS "dataValue",
         CASE WHEN event_type IN ('click', 'view', 'error') THEN 'Micrograms|Micrograms|Micrograms' ELSE 'Count' END
           AS "dataType"
  FROM events
"""


def particulates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    pair = F.concat_ws("%7c", F.col("event_id").cast("string"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind.isin("click", "view", "purchase"), "?g/m^3|PM1|PM2.5|PM10").otherwise(kind).alias("plotLabels"),
        F.when(kind == "purchase", F.col("event_id").cast("string"))
        .when(kind == "view", F.concat(pair, F.lit("%7c3%7c4")))
        .otherwise(F.concat(pair, F.lit("%7c3"))).alias("rawData"),
        F.concat_ws("|", F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.lit("3"))
        .alias("dataValue"),
        F.when(kind.isin("click", "view", "error"), "Micrograms|Micrograms|Micrograms").otherwise("Count")
        .alias("dataType"),
    )


# lineitem as wide channel history; a zero discount or tax is a missing value.
WIDE_SQL = """
  SELECT l_orderkey AS "ID", l_suppkey AS "INTERFACE_ID", l_shipdate AS "DATETIME", l_linenumber,
         l_quantity AS "AI1", l_extendedprice AS "AI2", nullif(l_discount, 0) AS "AI3", nullif(l_tax, 0) AS "AI4"
  FROM lineitem
"""


def wide_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ID"), F.col("l_suppkey").alias("INTERFACE_ID"),
        F.col("l_shipdate").alias("DATETIME"), "l_linenumber",
        F.col("l_quantity").alias("AI1"), F.col("l_extendedprice").alias("AI2"),
        F.nullif("l_discount", F.lit(0.0)).alias("AI3"), F.nullif("l_tax", F.lit(0.0)).alias("AI4"),
    )


def as_text(df: DataFrame, timestamp: str) -> DataFrame:
    """Timestamps as text with microseconds, as they arrive in JSON."""
    return df.withColumn(timestamp, F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def naive(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without zone, as the SQL side has them."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})
