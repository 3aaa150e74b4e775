from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from bindings.views import MESSAGES_SQL, PARTICULATE_SQL, messages, particulates
from sensorloom.functions import temporal
from sensorloom.functions.text import drop_last, remove_quotes, text_or_none_word
from sensorloom.operators import clean, combine, filters


@query("suffix_trim_by_prefix", f"""
WITH msg AS ({MESSAGES_SQL})
SELECT "dataMessageGUID", "sensorName",
       CASE WHEN regexp_matches("sensorName", '^(click|purchase)', 'i')
            THEN left("rawData", greatest(length("rawData") - 4, 0)) ELSE "rawData" END AS "rawData"
FROM msg
""")
def suffix_trim_by_prefix(spark, sf_dir):
    trimmed = clean.trim_suffix_by_prefix(messages(spark, sf_dir), ["Click", "PURCHASE"])
    return trimmed.select("dataMessageGUID", "sensorName", "rawData")


@query("component_realign", f"""
WITH p AS ({PARTICULATE_SQL}),
     good AS (SELECT *, string_split("rawData", '%7c') AS a FROM p
              WHERE NOT ("plotLabels" = '?g/m^3|PM1|PM2.5|PM10' AND len(string_split("rawData", '%7c')) < 3))
SELECT event_id, "plotLabels",
       CASE WHEN "plotLabels" = '?g/m^3|PM1|PM2.5|PM10'
            THEN '0%7c' || a[3] || '%7c' || a[1] || '%7c' || a[2] ELSE "rawData" END AS "rawData",
       CASE WHEN "plotLabels" = '?g/m^3|PM1|PM2.5|PM10' THEN '0|' || "dataValue" ELSE "dataValue" END AS "dataValue",
       CASE WHEN "dataType" = 'Micrograms|Micrograms|Micrograms'
            THEN 'Micrograms|Micrograms|Micrograms|Micrograms' ELSE "dataType" END AS "dataType"
FROM good
""")
def component_realign(spark, sf_dir):
    rows = particulates(spark, sf_dir)
    judged = clean.with_reject_reason(rows, {"too few particulate values": clean.particulate_too_short()})
    return clean.align_particulate(clean.split_rejects(judged)[0])


@query("component_rejects", f"""
WITH p AS ({PARTICULATE_SQL})
SELECT event_id, "rawData", 'too few particulate values' AS reject_reason FROM p
WHERE "plotLabels" = '?g/m^3|PM1|PM2.5|PM10' AND len(string_split("rawData", '%7c')) < 3
""")
def component_rejects(spark, sf_dir):
    rows = particulates(spark, sf_dir)
    judged = clean.with_reject_reason(rows, {"too few particulate values": clean.particulate_too_short()})
    return clean.split_rejects(judged)[1].select("event_id", "rawData", "reject_reason")


@query("flag_map", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS "pendingChange" FROM orders
""")
def flag_map(spark, sf_dir):
    status = F.col("o_orderstatus")
    words = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", "True").when(status == "O", "False").otherwise(status).alias("pendingChange"))
    return clean.flag_words_to_boolean(words, "pendingChange")


@query("overlay", """
SELECT c_custkey, coalesce(s_name, c_name) AS c_name,
       coalesce(CASE WHEN s_acctbal >= 0 THEN s_acctbal END, c_acctbal) AS c_acctbal
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
""")
def overlay(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    over = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("c_acctbal"))
    return clean.overlay(base, over, ["c_custkey"], ["c_name", "c_acctbal"])


@query("rename_drop_select", """
SELECT cast(c_custkey AS integer) AS "sensorID", c_name AS "sensorName", cast(c_nationkey AS varchar) AS "networkID"
FROM customer
""")
def rename_drop_select(spark, sf_dir):
    renamed = clean.rename_columns(
        table(spark, sf_dir, "customer"),
        {"c_custkey": "sensorID", "c_name": "sensorName", "c_nationkey": "networkID"})
    kept = clean.drop_columns(renamed, ["c_acctbal", "c_mktsegment", "c_comment"])
    return clean.cast_columns(kept, {"sensorID": "int", "networkID": "string"}).select(
        "sensorName", "sensorID", "networkID")


_CASTS_SQL = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE left(o_orderpriority, 1) END AS channel
FROM orders
"""


def _casts(spark, sf_dir):
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", priority).otherwise(F.left(priority, F.lit(1))).alias("channel"))


@query("lenient_cast", f"SELECT o_orderkey, try_cast(channel AS integer) AS channel FROM ({_CASTS_SQL})")
def lenient_cast(spark, sf_dir):
    return clean.cast_columns(_casts(spark, sf_dir), {"channel": "int"}, lenient=True)


@query("cast_rejects", f"""
SELECT o_orderkey, channel, 'channel is not int' AS reject_reason FROM ({_CASTS_SQL})
WHERE channel IS NOT NULL AND try_cast(channel AS integer) IS NULL
""")
def cast_rejects(spark, sf_dir):
    rows = _casts(spark, sf_dir)
    return clean.split_rejects(clean.with_reject_reason(rows, clean.cast_failures(rows, {"channel": "int"})))[1]


@query("network_filter", 'SELECT c_custkey, c_nationkey AS "networkID" FROM customer WHERE c_nationkey = 7')
def network_filter(spark, sf_dir):
    return filters.keep_network(
        table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("networkID")), 7)


@query("sensor_in_list", "SELECT event_id, event_type, value FROM events WHERE event_type IN ('error', 'signup')")
def sensor_in_list(spark, sf_dir):
    return filters.keep_listed(
        table(spark, sf_dir, "events").select("event_id", "event_type", "value"), "event_type", ["error", "signup"])


@query("sensor_in_table", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def sensor_in_table(spark, sf_dir):
    listed = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select("c_custkey")
    return filters.keep_listed(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", listed)


@query("drop_null_key", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events WHERE event_type <> 'error'
""")
def drop_null_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"))
    return filters.drop_null_keys(rows, ["user_id"])


@query("optional_children", """
SELECT o_orderkey, o_orderdate AS "lastUpdate" FROM orders WHERE o_orderstatus <> 'P'
""")
def optional_children(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("lastUpdate"))
    return filters.present_only(rows, "lastUpdate")


@query("append_by_name", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::double AS balance FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def append_by_name(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    right = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return combine.append_by_name(left, right)


@query("text_functions", """
SELECT p_partkey, replace('"' || p_name || '"', '"', '') AS unquoted,
       left(p_name, greatest(length(p_name) - 5, 0)) AS shortened,
       coalesce(CASE WHEN p_size > 25 THEN p_type END, 'None') AS worded
FROM part
""")
def text_functions(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        remove_quotes(F.concat(F.lit('"'), "p_name", F.lit('"'))).alias("unquoted"),
        drop_last(F.col("p_name"), 5).alias("shortened"),
        text_or_none_word(F.when(F.col("p_size") > 25, F.col("p_type"))).alias("worded"))


@query("parse_epoch_wrapper", """
SELECT event_id, date_trunc('second', ts) AS parsed FROM events
""")
def parse_epoch_wrapper(spark, sf_dir):
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        temporal.epoch_wrapper_to_timestamp(F.concat(F.lit("/Date("), millis, F.lit(")/")))
        .cast("timestamp_ntz").alias("parsed"))


@query("parse_lenient_dayfirst", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS parsed FROM events
""")
def parse_lenient_dayfirst(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    date = F.when(F.col("event_type") == "error", "31/02/2024").otherwise(F.date_format("ts", "d/M/yyyy"))
    return events.select(
        "event_id",
        temporal.lenient_day_first(date, F.date_format("ts", "H:mm:ss")).cast("timestamp_ntz").alias("parsed"))


@query("parse_iso", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN ts - INTERVAL 1 HOUR END AS parsed FROM events
""")
def parse_iso(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'419+01:00'")
    return table(spark, sf_dir, "events").select(
        "event_id",
        temporal.iso_timestamp(F.when(F.col("event_type") == "error", "no date").otherwise(text))
        .cast("timestamp_ntz").alias("parsed"))


@query("parse_fixed_formats", """
SELECT event_id, date_trunc('second', ts) AS plain, date_trunc('second', ts) - INTERVAL 2 HOUR AS with_offset,
       strftime(ts, '%Y/%m/%d') AS day, cast(ts AS date) + 1 AS next_day
FROM events
""")
def parse_fixed_formats(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        temporal.plain_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("plain"),
        temporal.offset_timestamp(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+0200'")).cast("timestamp_ntz")
        .alias("with_offset"),
        temporal.day_text(F.col("ts")).alias("day"),
        F.date_add(F.to_date("ts"), 1).alias("next_day"))


@query("parse_early_epoch", """
SELECT o_orderkey, o_orderdate - INTERVAL 25 YEAR AS parsed FROM orders
""")
def parse_early_epoch(spark, sf_dir):
    """Epochs with fewer digits, and negative ones, of devices whose clock was reset; with a zone offset behind."""
    date = F.col("o_orderdate").cast("timestamp") - F.expr("INTERVAL 25 YEAR")
    millis = F.unix_millis(date).cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        temporal.epoch_wrapper_to_timestamp(F.concat(F.lit("/Date("), millis, F.lit("+0100)/")))
        .cast("timestamp_ntz").alias("parsed"))


@query("parse_date_spellings", """
SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('minute', ts) WHEN 'view' THEN date_trunc('day', ts)
                                 WHEN 'signup' THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END AS parsed
FROM events
""")
def parse_date_spellings(spark, sf_dir):
    """Five spellings: without seconds, without a time, year first, two-digit years, and with a fraction."""
    kind = F.col("event_type")
    date = (F.when(kind == "click", F.date_format("ts", "dd/MM/yyyy")).when(kind == "view", F.date_format("ts", "d-M-yyyy"))
            .when(kind == "error", F.date_format("ts", "yyyy-MM-dd")).when(kind == "purchase", F.date_format("ts", "d.M.yy"))
            .otherwise(F.date_format("ts", "d/M/yyyy")))
    time = (F.when(kind == "click", F.date_format("ts", "H:mm")).when(kind == "signup", F.date_format("ts", "HH:mm:ss.SSS"))
            .when(kind != "view", F.date_format("ts", "H:mm:ss")))
    return table(spark, sf_dir, "events").select(
        "event_id", temporal.lenient_day_first(date, time).cast("timestamp_ntz").alias("parsed"))
