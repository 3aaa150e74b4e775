import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from sensorloom import session
from sensorloom.operators import resample
from sensorloom.plans import uplink, water
from sensorloom.session import shared_folder
from sensorloom.sources.documents import read_documents, readable
from sensorloom.sources.schemas import UPLINK_DOCUMENT, WATER_POLL
from sensorloom.sources.tables import read_table
from sensorloom.streaming.events import append_parquet, dedupe_stream, resample_stream
from sensorloom.streaming.ingest import ingest, trigger_options
from test_feeds import CURRENT, FAR, NEAR, _block, _uplink


def _land(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(document) for document in documents))


def test_uplink_stream_resumes_and_repeats_nothing(spark, tmp_path):
    landing, root, checkpoint, rejects = (tmp_path / name for name in ("landing", "tables", "checkpoint", "rejects"))

    def run():
        documents = read_documents(spark, str(landing), UPLINK_DOCUMENT, stream=True)
        ingest(documents, uplink.prepare, uplink.tables, uplink.TABLES, str(root), str(checkpoint),
               rejects=str(rejects)).awaitTermination()
        return {name: read_table(spark, str(root), spec).count() for name, spec in uplink.TABLES.items()}

    _land(landing, "1.json", _uplink(CURRENT, [NEAR, FAR]), _uplink({}, [NEAR], f_cnt=3))
    first = run()
    assert first["uplink_uplinks"] == 1 and first["uplink_rx"] == 2 and first["uplink_gateways"] == 2
    assert run() == first
    _land(landing, "2.json", _uplink(CURRENT, [NEAR], f_cnt=2))
    second = run()
    assert second["uplink_uplinks"] == 2 and second["uplink_rx"] == 3
    assert second["uplink_gateways"] == 2 and second["uplink_devices"] == 1
    assert spark.read.json(str(rejects / "rejected")).count() == 1
    assert (rejects / "unreadable").is_dir()


def test_a_repeated_micro_batch_replaces_its_rows(spark, tmp_path):
    """The checkpoint is lost after the writes: the same batch numbers come again."""
    landing, root = tmp_path / "landing", tmp_path / "tables"
    _land(landing, "1.json", {"unit": {"id": 1, "name": "u"}, "document": {
        "success": "true", "message": "m", "now": "2021-03-29T13:00:00+01:00",
        "details": {"name": "d", "tz": "UTC", "update_cycle": 1}, "blocks": [_block()]}})
    counts = []
    for checkpoint in ("one", "two"):
        documents = readable(read_documents(spark, str(landing), WATER_POLL, stream=True))
        ingest(documents, water.prepare, water.tables, water.TABLES, str(root), str(tmp_path / checkpoint)
               ).awaitTermination()
        counts.append({name: read_table(spark, str(root), spec).count() for name, spec in water.TABLES.items()})
    assert counts[0] == counts[1] and min(counts[0].values()) > 0


SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("ts", T.StringType()), T.StructField("v", T.DoubleType())])


def _events(spark, tmp_path, rows):
    _land(tmp_path / "events", "1.json", *[{"id": i, "ts": ts, "v": v} for i, ts, v in rows])
    return spark.readStream.schema(SCHEMA).json(str(tmp_path / "events"))


ROWS = [(1, "2024-01-01T00:01:00", 1.0), (1, "2024-01-01T00:01:00", 1.0), (2, "2024-01-01T00:09:00", 3.0),
        (3, "2024-01-01T00:10:00", None), (4, "2024-01-01T05:00:00", 5.0)]


def test_stream_dedupe(spark, tmp_path):
    out = str(tmp_path / "out")
    append_parquet(dedupe_stream(_events(spark, tmp_path, ROWS), ["id"], "ts"), out,
                   str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(row.id for row in spark.read.parquet(out).collect()) == [1, 2, 3, 4]


def test_stream_resample_equals_batch_on_closed_bins(spark, tmp_path):
    out = str(tmp_path / "out")
    bins = resample_stream(_events(spark, tmp_path, ROWS), "ts", ["v"], "10min", delay="1 hour")
    append_parquet(bins, out, str(tmp_path / "checkpoint")).awaitTermination()
    stream = {row.ts: row.v for row in spark.read.parquet(out).collect()}
    batch = spark.createDataFrame(ROWS, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    whole = {row.ts: row.v for row in resample.resample_mean(batch, "ts", ["v"], "10min").collect()}
    assert len(stream) == 2 and stream == {ts: v for ts, v in whole.items() if ts.hour == 0}
    with pytest.raises(ValueError):
        resample_stream(_events(spark, tmp_path, ROWS), "ts", ["v"], "7min")


def test_triggers():
    assert trigger_options(None) == {"availableNow": True}
    assert trigger_options("15 minutes") == {"processingTime": "15 minutes"}


def test_shared_folder_follows_the_session(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_scratch_of_the_application_is_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_scratch", lambda _: str(tmp_path / "app"))
    folder, kept = session.shared_folder(spark, "x"), tmp_path / "other"
    spark.range(3).write.parquet(folder)
    spark.range(3).write.parquet(str(kept))
    assert session.remove_scratch(spark) and not os.path.exists(folder) and kept.exists()
    assert not session.remove_scratch(spark)
