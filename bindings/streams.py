"""Streams over a landing folder that holds the events as JSON files, run until it is read."""

from __future__ import annotations

import datetime as dt
import time
from functools import partial

from pyspark.sql import functions as F, types as T

from bindings.indoor_feed import ROWS_SQL, SETTINGS
from bindings.registry import once, query, table
from bindings.views import as_text, messages
from sensorloom.operators import resample
from sensorloom.plans import indoor, reports
from sensorloom.session import shared_folder
from sensorloom.sources import landing
from sensorloom.sources.documents import UNREADABLE, read_documents, unwrap
from sensorloom.sources.schemas import INDOOR_MESSAGE
from sensorloom.sources.tables import read_table, read_tables
from sensorloom.streaming import events as event_streams
from sensorloom.streaming.bins import Bins, merge_bins, read_bins, stream_bins
from sensorloom.streaming.ingest import ingest

_ENVELOPE = T.StructType([T.StructField("sensorMessages", T.ArrayType(INDOOR_MESSAGE))])


def _ingested(spark, sf_dir) -> str:
    return once(spark, sf_dir, "tables", lambda root: _run_ingest(spark, sf_dir, root))


def _run_ingest(spark, sf_dir, root: str) -> None:
    """Messages landed as three drops, the last one a repeat, ingested by three runs of the same stream."""
    landed, checkpoint = shared_folder(spark, "landing"), shared_folder(spark, "checkpoint")
    sent = messages(spark, sf_dir)
    loud = F.col("pendingChange").isNotNull()
    for drop in (sent.filter(loud), sent.filter(~loud), sent.filter(loud)):
        _land(drop, landed)
        _ingest(spark, landed, root, checkpoint).awaitTermination()


def _land(drop, folder: str) -> None:
    body = F.struct(*[name for name in drop.columns if name in INDOOR_MESSAGE.names])
    as_text(drop, "messageDate").select(F.array(body).alias("sensorMessages")).write.mode("append").option(
        "compression", "gzip").json(folder)


def _ingest(spark, landed: str, root: str, checkpoint: str, **options):
    return ingest(
        read_documents(spark, landed, _ENVELOPE, stream=True), partial(indoor.prepare, settings=SETTINGS), indoor.tables,
        indoor.TABLES, root, checkpoint, unwrapped=lambda documents: unwrap(documents, "sensorMessages"), **options)


@query("stream_ingest", f"""
WITH {ROWS_SQL}
SELECT "readingID", "sensorName", "messageDate", "rawData", "dataValue", "dataType", "plotValue", "plotLabel",
       "voltage", "pendingChange"
FROM readings
""")
def stream_ingest(spark, sf_dir):
    """The tables that the stream wrote, joined again to its readings with two of their children."""
    root = _ingested(spark, sf_dir)
    tables = read_tables(spark, root, indoor.TABLES)
    keys = ["readingID", "dataMessageGUID"]
    rows = (
        tables["indoor_readings"]
        .join(tables["indoor_sensors"].select("sensorID", "sensorName"), "sensorID")
        .join(tables["indoor_data_types"], "dataTypeID").join(tables["indoor_plot_labels"], "plotLabelID")
        .join(tables["indoor_sensor_voltage"].drop("batch", "day"), keys)
        .join(tables["indoor_pending_changes"].drop("batch", "day"), keys))
    return rows.select(
        "readingID", "sensorName", F.col("messageDate").cast("timestamp_ntz").alias("messageDate"), "rawData",
        "dataValue", "dataType", "plotValue", "plotLabel", "voltage", "pendingChange")


@query("stored_day_report", f"""
WITH {ROWS_SQL}
SELECT "sensorName", "messageDate", "rawData", "dataValue", "dataType", "plotValue", "plotLabel" FROM readings
WHERE "messageDate" > TIMESTAMP '2024-01-03 12:00:00' AND "messageDate" < TIMESTAMP '2024-01-06'
ORDER BY "messageDate" DESC
""")
def stored_day_report(spark, sf_dir):
    """The range report on the stored tables, which are partitioned by day."""
    root = _ingested(spark, sf_dir)
    tables = read_tables(spark, root, indoor.TABLES)
    report = reports.indoor_report(tables, dt.datetime(2024, 1, 3, 12), dt.datetime(2024, 1, 6))
    return report.withColumn("messageDate", F.col("messageDate").cast("timestamp_ntz"))


def _landed_events(spark, sf_dir, twice: bool = False):
    landed = shared_folder(spark, "landing")
    events = table(spark, sf_dir, "events")
    as_text(events.unionByName(events) if twice else events, "ts").write.json(landed)
    schema = T.StructType([
        field if field.name != "ts" else T.StructField("ts", T.StringType()) for field in events.schema.fields])
    return read_documents(spark, landed, schema, stream=True).drop(UNREADABLE)


@query("stream_dedupe", "SELECT event_id, ts, user_id, event_type FROM events")
def stream_dedupe(spark, sf_dir):
    """Every event landed twice, kept once."""
    out, checkpoint = shared_folder(spark, "unique"), shared_folder(spark, "checkpoint")
    unique = event_streams.dedupe_stream(
        _landed_events(spark, sf_dir, twice=True), ["event_id", "user_id", "event_type"], "ts")
    event_streams.append_parquet(unique, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")


@query("stream_resample", """
SELECT event_type, time_bucket(INTERVAL '10 minutes', ts) AS ts, round(avg(value), 6) AS value FROM events
WHERE time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' <=
      (SELECT max(ts) - INTERVAL '1 hour' FROM events)
GROUP BY 1, 2
""")
def stream_resample(spark, sf_dir):
    """Bins that closed before the end of the stream."""
    out, checkpoint = shared_folder(spark, "bins"), shared_folder(spark, "checkpoint")
    bins = event_streams.resample_stream(
        _landed_events(spark, sf_dir), "ts", ["value"], "10min", ["event_type"], "1 hour")
    event_streams.append_parquet(bins, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(
        "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), F.round("value", 6).alias("value"))


@query("stream_archive", "SELECT count(*) AS lines, count(DISTINCT event_id) AS events FROM events")
def stream_archive(spark, sf_dir):
    """Raw payload text of a stream, kept before anything is parsed."""
    landed, out, checkpoint = (shared_folder(spark, name) for name in ("landing", "archive", "checkpoint"))
    table(spark, sf_dir, "events").write.json(landed)
    lines = landing.raw_lines(spark, landed, stream=True)
    event_streams.append_parquet(lines, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).agg(
        F.count("*").alias("lines"),
        F.countDistinct(F.get_json_object("payload", "$.event_id")).alias("events"))


@query("stream_resample_complete", """
SELECT event_type, time_bucket(INTERVAL '10 minutes', ts) AS ts, round(avg(value), 6) AS value FROM events GROUP BY 1, 2
""")
def stream_resample_complete(spark, sf_dir):
    """All bins, the last and late ones too: the batch operator over the raw archive that a stream wrote."""
    landed, out, checkpoint = (shared_folder(spark, name) for name in ("landing", "archive", "checkpoint"))
    events = table(spark, sf_dir, "events")
    as_text(events, "ts").write.json(landed)
    event_streams.append_parquet(landing.raw_lines(spark, landed, stream=True), out, checkpoint).awaitTermination()
    schema = "event_type string, ts timestamp_ntz, value double"
    rows = spark.read.parquet(out).select(F.from_json("payload", schema).alias("row")).select("row.*")
    bins = resample.resample_mean(rows, "ts", ["value"], "10min", ["event_type"])
    return bins.withColumn("value", F.round("value", 6))


@query("stream_bins_with_late_rows", """
SELECT event_type, time_bucket(INTERVAL '10 minutes', ts) AS ts, round(avg(value), 6) AS value FROM events GROUP BY 1, 2
""")
def stream_bins_with_late_rows(spark, sf_dir):
    """Three drops, each over all of the time, so most rows of the later ones are late; all bins are whole."""
    landed, root, checkpoint = (shared_folder(spark, name) for name in ("landing", "bins", "checkpoint"))
    events = as_text(table(spark, sf_dir, "events"), "ts")
    schema = T.StructType([
        field if field.name != "ts" else T.StructField("ts", T.StringType()) for field in events.schema.fields])
    bins = Bins("event_bins", "ts", ("value",), "10min", "event_type string")
    for turn in range(3):
        events.filter(F.pmod("event_id", F.lit(3)) == turn).write.mode("append").json(landed)
        rows = read_documents(spark, landed, schema, stream=True).drop(UNREADABLE)
        stream_bins(rows, bins, root, checkpoint).awaitTermination()
        if turn == 1 and merge_bins(spark, root, bins, least=2) < 2:
            raise ValueError("no folders were put together")
    return read_bins(spark, root, bins).select(
        "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), F.round("value", 6).alias("value"))


@query("stream_rejects", """
SELECT 'unreadable record' AS reject_reason, count(*) AS records FROM events WHERE event_type = 'error'
UNION ALL SELECT 'unreadable message date', count(*) FROM events WHERE event_type = 'view'
UNION ALL SELECT 'accepted', count(*) FROM events WHERE event_type NOT IN ('error', 'view')
""")
def stream_rejects(spark, sf_dir):
    """A stream with broken lines and unreadable dates: what it keeps of them, and the messages it accepts."""
    landed, root, checkpoint = (shared_folder(spark, name) for name in ("landing", "tables", "checkpoint"))
    kind = F.element_at(F.split("sensorName", " "), 1)
    sent = as_text(messages(spark, sf_dir), "messageDate").withColumn(
        "messageDate", F.when(kind == "view", F.lit("soon")).otherwise(F.col("messageDate")))
    line = F.to_json(F.struct(F.array(F.struct(*[c for c in sent.columns])).alias("sensorMessages")))
    sent.select(F.when(kind == "error", F.left(line, F.length(line) - 2)).otherwise(line).alias("value")).write.text(landed)
    _ingest(spark, landed, root, checkpoint).awaitTermination()
    unreadable, rejected = (
        spark.read.schema("reject_reason string").json(f"{root}/rejects/{name}").select("reject_reason")
        for name in ("unreadable", "rejected"))
    lost = unreadable.unionAll(rejected)
    stored = read_table(spark, root, indoor.TABLES["indoor_readings"]).select("dataMessageGUID").distinct()
    return lost.groupBy("reject_reason").agg(F.count("*").alias("records")).unionByName(
        stored.agg(F.count("*").alias("records")).withColumn("reject_reason", F.lit("accepted")))


@query("two_streams_one_store", "SELECT count(*) AS messages, 2 AS streams FROM events")
def two_streams_one_store(spark, sf_dir):
    """Two streams with checkpoints of their own fill one store, both with batches from 0 on."""
    root = shared_folder(spark, "tables")
    sent = messages(spark, sf_dir)
    loud = F.col("pendingChange").isNotNull()
    running = []
    for part in (sent.filter(loud), sent.filter(~loud)):
        landed, checkpoint = shared_folder(spark, "landing"), shared_folder(spark, "checkpoint")
        _land(part, landed)
        running.append(_ingest(spark, landed, root, checkpoint))
    for stream in running:
        stream.awaitTermination()
    stored = read_table(spark, root, indoor.TABLES["indoor_readings"])
    return stored.agg(
        F.countDistinct("dataMessageGUID").alias("messages"), F.countDistinct("batch").cast("int").alias("streams"))


@query("new_checkpoint_same_store", "SELECT count(*) AS messages FROM events")
def new_checkpoint_same_store(spark, sf_dir):
    """The landing folder is emptied and the stream starts anew: what the first stream stored stays."""
    root = shared_folder(spark, "tables")
    sent = messages(spark, sf_dir)
    loud = F.col("pendingChange").isNotNull()
    for part in (sent.filter(loud), sent.filter(~loud)):
        landed, checkpoint = shared_folder(spark, "landing"), shared_folder(spark, "checkpoint")
        _land(part, landed)
        _ingest(spark, landed, root, checkpoint).awaitTermination()
    stored = read_table(spark, root, indoor.TABLES["indoor_readings"])
    return stored.agg(F.countDistinct("dataMessageGUID").alias("messages"))


@query("stream_polled", "SELECT count(*) AS messages FROM events")
def stream_polled(spark, sf_dir):
    """The feed polled on a timer, stopped after its first batch."""
    landed, root, checkpoint = (shared_folder(spark, name) for name in ("landing", "tables", "checkpoint"))
    _land(messages(spark, sf_dir), landed)
    running = _ingest(spark, landed, root, checkpoint, period="15 minutes")
    while running.isActive and running.lastProgress is None:  # the first batch starts at once
        time.sleep(0.1)
    running.stop()
    stored = read_table(spark, root, indoor.TABLES["indoor_readings"])
    return stored.agg(F.countDistinct("dataMessageGUID").alias("messages"))
