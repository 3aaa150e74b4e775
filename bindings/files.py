"""Files: the given tables are written in the source formats into the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from bindings.registry import query, table
from bindings.time_series import _rounded
from bindings.uplink_feed import UPLINKS_SQL, documents
from bindings.views import MESSAGES_SQL, messages
from sensorloom.functions.temporal import lenient_day_first
from sensorloom.operators.clean import cast_columns
from sensorloom.plans import logger, uplink
from sensorloom.session import shared_folder
from sensorloom.sources import delimited, landing
from sensorloom.sources.documents import read_documents, read_envelope
from sensorloom.sources.schemas import INDOOR_MESSAGE


@query("json_envelope_rows", f"""
SELECT "dataMessageGUID", "sensorName", "rawData", "plotLabels", "batteryLevel", "signalStrength", "pendingChange"
FROM ({MESSAGES_SQL})
""")
def json_envelope_rows(spark, sf_dir):
    """Documents with a list of two sensor messages and a gateway message, which is ignored."""
    folder = shared_folder(spark, "envelope")
    columns = ["dataMessageGUID", "sensorName", "rawData", "plotLabels", "batteryLevel", "signalStrength",
               "pendingChange"]
    message = F.struct(*columns)
    sent = messages(spark, sf_dir)
    quiet = F.col("pendingChange").isNull()
    sent.filter(~quiet).select(
        F.struct(F.lit("gw").alias("gatewayName")).alias("gatewayMessage"), F.array(message).alias("sensorMessages"),
    ).write.json(f"{folder}/loud")
    sent.filter(quiet).select(F.array(message).alias("sensorMessages")).write.json(f"{folder}/quiet")
    read = read_envelope(spark, f"{folder}/*", INDOOR_MESSAGE, "sensorMessages").select(*columns)
    return cast_columns(read, {"batteryLevel": "int", "signalStrength": "double"}, lenient=True)


@query("optional_fields", f"""
WITH {UPLINKS_SQL}
SELECT uplink_guid, session_key_id, cast(k AS integer) AS f_port, frm_payload,
       CASE event_type WHEN 'click' THEN cast(event_id AS varchar) WHEN 'error' THEN cast(user_id AS varchar)
       END AS raw_bytes,
       CASE WHEN event_type <> 'error' THEN cast(user_id + 0.5 AS double) END AS consumed_airtime
FROM up
""")
def optional_fields(spark, sf_dir):
    """Nested documents from JSON files, where absent keys are simply not written."""
    return uplink.build(documents(spark, sf_dir))["uplink_uplinks"].select(
        "uplink_guid", "session_key_id", "f_port", "frm_payload", "raw_bytes", "consumed_airtime")


@query("unreadable_documents", """
SELECT '{"k": ' || o_orderkey AS unreadable_record, 0 AS read_columns FROM orders WHERE o_orderstatus = 'P'
""")
def unreadable_documents(spark, sf_dir):
    folder = shared_folder(spark, "broken")
    body = F.concat(F.lit('{"k": '), F.col("o_orderkey").cast("string"))
    table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", body).otherwise(F.concat(body, F.lit("}"))).alias("value"),
    ).write.text(folder)
    read = read_documents(spark, folder, T.StructType([T.StructField("absent", T.LongType())]))
    return read.filter(F.col("unreadable_record").isNotNull()).select(
        "unreadable_record", F.col("absent").isNotNull().cast("int").alias("read_columns"))


@query("csv_round_trip", """
SELECT event_id, event_type, user_id, props FROM events
""")
def csv_round_trip(spark, sf_dir):
    """Two appends to one folder, each file with its own header line."""
    folder = shared_folder(spark, "csv")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "props")
    delimited.append_csv(events.filter("event_type = 'error'"), folder)
    delimited.append_csv(events.filter("event_type <> 'error'"), folder)
    return delimited.read_history(spark, folder, events.schema)


@query("raw_archive", """
SELECT o_orderkey || ',' || o_orderpriority AS payload, 1 AS known_file FROM orders
""")
def raw_archive(spark, sf_dir):
    landed, archive = shared_folder(spark, "landed"), shared_folder(spark, "archive")
    table(spark, sf_dir, "orders").select(
        F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value")).write.text(landed)
    landing.archive_raw(landing.raw_lines(spark, landed), archive)
    rows = spark.read.parquet(archive)
    return rows.select("payload", F.contains("source_file", F.lit("landed")).cast("int").alias("known_file"))


@query("day_slice", """
SELECT event_id, cast(ts AS date) AS day FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
""")
def day_slice(spark, sf_dir):
    """A half-open range of days from a landing folder; other days' files are not read."""
    folder = shared_folder(spark, "days")
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    events.hint("rebalance", "day").write.partitionBy("day").json(folder)
    schema = T.StructType([T.StructField("event_id", T.LongType())])
    return landing.read_days(spark, folder, schema, "2024-01-10", "2024-01-20")


def _write_logger_files(spark, sf_dir) -> str:
    """Clicks and views as quoted files with channels 10668 and 10670, errors as plain files with
    10670 and 10671; signups have no readable date."""
    folder = shared_folder(spark, "logger")
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_type",
        F.when(kind == "signup", "soon").otherwise(F.date_format("ts", "d/M/yyyy")).alias("DATE"),
        F.date_format("ts", "H:mm:ss").alias("TIME"),
        F.col("user_id").cast("string").alias("user"),
        F.when(kind != "view", F.col("event_id").cast("string")).alias("event"))
    quoted = rows.filter("event_type IN ('click', 'view', 'signup')").select(
        "DATE", "TIME", F.col("user").alias("10668"), F.col("event").alias("10670"))
    plain = rows.filter("event_type IN ('error', 'purchase')").select(
        "DATE", "TIME", F.col("user").alias("10670"), F.col("event").alias("10671"))
    quoted.write.option("sep", ";").option("header", True).option("quoteAll", True).csv(f"{folder}/quoted")
    plain.write.option("sep", ";").option("header", True).csv(f"{folder}/plain")
    return folder


_LOGGER_SQL = """
  lines AS (SELECT date_trunc('second', ts) AS date_time, event_type, user_id, event_id FROM events
            WHERE event_type <> 'signup'),
  wide AS (
    SELECT date_time, CASE WHEN event_type IN ('click', 'view') THEN cast(user_id AS double) END AS "10668",
           CASE event_type WHEN 'click' THEN cast(event_id AS double) WHEN 'view' THEN NULL
                           ELSE cast(user_id AS double) END AS "10670",
           CASE WHEN event_type IN ('error', 'purchase') THEN cast(event_id AS double) END AS "10671"
    FROM lines)
"""
_CHANNELS = ["10668", "10670", "10671"]


@query("logger_csv_merge", f"WITH {_LOGGER_SQL} SELECT * FROM wide")
def logger_csv_merge(spark, sf_dir):
    merged = logger.merged_wide(spark, f"{_write_logger_files(spark, sf_dir)}/*", _CHANNELS)
    return merged.withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))


@query("logger_resampled", f"""
WITH {_LOGGER_SQL},
  means AS (SELECT time_bucket(INTERVAL '10 minutes', date_time) AS date_time, round(avg("10668"), 6) AS "10668",
                   round(avg("10670"), 6) AS "10670", round(avg("10671"), 6) AS "10671" FROM wide GROUP BY 1),
  grid AS (SELECT unnest(generate_series(min(date_time), max(date_time), INTERVAL '10 minutes')) AS date_time
           FROM means)
SELECT grid.date_time, "10668", "10670", "10671" FROM grid LEFT JOIN means ON means.date_time = grid.date_time
""")
def logger_resampled(spark, sf_dir):
    """Source files, the merged file, and the resampled file read back."""
    source, merged, resampled = (
        _write_logger_files(spark, sf_dir), shared_folder(spark, "merged"), shared_folder(spark, "resampled"))
    logger.merge_and_resample(spark, f"{source}/*", _CHANNELS, merged, resampled)
    rows = _rounded(logger.read_merged(spark, resampled, _CHANNELS), *_CHANNELS)
    return rows.withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))


@query("logger_long", f"""
WITH {_LOGGER_SQL},
  long AS (FROM wide UNPIVOT (value FOR channel IN ("10668", "10670", "10671"))),
  all_bins AS (
    SELECT '10668' AS channel, date_time FROM lines WHERE event_type IN ('click', 'view')
    UNION ALL SELECT '10670', date_time FROM lines
    UNION ALL SELECT '10671', date_time FROM lines WHERE event_type IN ('error', 'purchase')),
  means AS (SELECT channel, time_bucket(INTERVAL '10 minutes', date_time) AS date_time, round(avg(value), 6) AS value
            FROM long GROUP BY 1, 2),
  grid AS (SELECT channel, unnest(generate_series(time_bucket(INTERVAL '10 minutes', min(date_time)),
                                                  time_bucket(INTERVAL '10 minutes', max(date_time)),
                                                  INTERVAL '10 minutes')) AS date_time
           FROM all_bins GROUP BY channel)
SELECT grid.channel, grid.date_time, means.value
FROM grid LEFT JOIN means ON means.channel = grid.channel AND means.date_time = grid.date_time
""")
def logger_long(spark, sf_dir):
    """A grid per channel, without a list of channels."""
    rows = _rounded(logger.resampled_long(spark, f"{_write_logger_files(spark, sf_dir)}/*"), "value")
    return rows.withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))


@query("logger_known_layout", """
SELECT date_trunc('second', ts) AS date_time, cast(user_id AS varchar) AS "10670" FROM events
WHERE event_type IN ('error', 'purchase')
""")
def logger_known_layout(spark, sf_dir):
    rows = delimited.read_logger_layout(
        spark, f"{_write_logger_files(spark, sf_dir)}/plain", ["DATE", "TIME", "10670", "10671"])
    return rows.select(
        lenient_day_first(F.col("DATE"), F.col("TIME")).cast("timestamp_ntz").alias("date_time"), "10670")


@query("logger_rejects", """
SELECT CASE WHEN event_type = 'signup' THEN 'unreadable date' WHEN event_type = 'error' THEN 'no header with date and time' END
         AS reject_reason, count(*) + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS line_count
FROM events WHERE event_type IN ('signup', 'error') GROUP BY event_type
""")
def logger_rejects(spark, sf_dir):
    """Lines that the readers leave out: of a file whose header has other names, and with unreadable dates."""
    folder = shared_folder(spark, "logger")
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_type", F.when(kind == "signup", "soon").otherwise(F.date_format("ts", "d/M/yyyy")).alias("DATE"),
        F.date_format("ts", "H:mm:ss").alias("TIME"), F.col("user_id").cast("string").alias("10668"))
    writer = lambda chosen: chosen.coalesce(1).write.option("sep", ";").option("header", True)
    writer(rows.filter("event_type <> 'error'").drop("event_type")).csv(f"{folder}/known")
    writer(rows.filter("event_type = 'error'").drop("event_type").withColumnsRenamed({"DATE": "Date", "TIME": "Time"})).csv(
        f"{folder}/other")
    rejected = delimited.read_logger_rejects(spark, f"{folder}/*")
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("line_count"))


@query("day_slice_refetched", """
SELECT event_id, cast(ts AS date) AS day FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'
""")
def day_slice_refetched(spark, sf_dir):
    """Days of a range that have not landed are found in the folder, fetched again, and the range is read whole."""
    folder = shared_folder(spark, "days")
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    events.filter(F.dayofmonth("day") % 3 != 0).hint("rebalance", "day").write.partitionBy("day").json(folder)
    schema = T.StructType([T.StructField("event_id", T.LongType())])
    landed = landing.read_days(spark, folder, schema, "2024-01-05", "2024-01-25")
    missing = landing.missing_days(landed, "day", "2024-01-05", "2024-01-25")
    events.join(missing, "day").hint("rebalance", "day").write.mode("append").partitionBy("day").json(folder)
    return landing.read_days(spark, folder, schema, "2024-01-05", "2024-01-25")
