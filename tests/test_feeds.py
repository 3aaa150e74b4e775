import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from sensorloom.functions.temporal import plain_timestamp
from sensorloom.plans import checks, indoor, reports, uplink, water
from sensorloom.plans.load import load_batch
from sensorloom.sources.documents import read_documents, read_envelope, readable
from sensorloom.sources.schemas import (
    INDOOR_MESSAGE, REST_GATEWAY, REST_MESSAGE, REST_SENSOR, UPLINK_DOCUMENT, WATER_POLL,
)
from sensorloom.sources.tables import dimension_rows, read_table

GUID = "00000000-0000-0000-0000-00000000000"


def _write(folder, *documents):
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(json.dumps(document) for document in documents))
    return str(folder)


def _message(number, **changes):
    return {
        "dataMessageGUID": GUID + str(number), "sensorName": "Humidity - hall", "networkID": 1, "applicationID": 43,
        "rawData": "21.5%7c400000", "dataValue": "21.5|40", "dataType": "TemperatureData|Percentage",
        "plotValues": "70.7|40", "plotLabels": "Fahrenheit|Humidity", "messageDate": "2021-03-29 12:26:09",
        "signalStrength": "-60.5", "voltage": 3.1, "batteryLevel": "100", "pendingChange": "False", **changes}


@pytest.fixture(scope="module")
def indoor_messages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("indoor") / "landing"
    path = _write(
        folder,
        {"gatewayMessage": {"gatewayID": 1}, "sensorMessages": [
            _message(1), _message(1), _message(2, networkID=2, messageDate="2021-03-30 00:00:00")]},
        {"sensorMessages": [
            _message(3, sensorName="Air", plotLabels="?g/m^3|PM1|PM2.5|PM10", rawData="1%7c2%7c3", dataValue="1|2|3",
                     dataType="Micrograms|Micrograms|Micrograms", plotValues="1|2|3|4", pendingChange="True"),
            _message(4, sensorName="Air", plotLabels="?g/m^3|PM1|PM2.5|PM10", rawData="1"),
            _message(5, messageDate="not a date"), _message(7, networkID="none"), _message(6, plotLabels="%", plotValues=None, rawData="x"),
        ]})
    return read_envelope(spark, path, INDOOR_MESSAGE)


def test_indoor_rows_and_rejects(indoor_messages):
    rows, rejected = indoor.prepare(indoor_messages, indoor.IndoorSettings(sensor_types=["humidity"]))
    assert {row.reject_reason for row in rejected.collect()} == {
        "unreadable message date", "too few particulate values", "networkID is not int"}
    first = sorted(
        (row.rawData, row.dataValue, row.dataType, row.plotValue, row.plotLabel)
        for row in rows.filter(F.col("dataMessageGUID") == GUID + "2").collect())
    assert first == [("21.5", "21.5", "TemperatureData", "70.7", "Fahrenheit"), ("40", "40", "Percentage", "40", "Humidity")]
    air = sorted((row.plotLabel, row.rawData, row.dataValue, row.pendingChange) for row in rows.filter(
        "sensorName = 'Air'").collect())
    assert air == [("?g/m^3", "0", "0", True), ("PM1", "3", "1", True), ("PM10", "2", "3", True), ("PM2.5", "1", "2", True)]


def test_indoor_tables_satisfy_their_constraints(indoor_messages):
    frames = indoor.build(indoor_messages, indoor.IndoorSettings(sensor_types=["humidity"]))
    assert set(frames) == set(indoor.TABLES)
    stored = {
        name: dimension_rows(frame, indoor.TABLES[name]) if indoor.TABLES[name].is_dimension else frame.distinct()
        for name, frame in frames.items()}
    found = {(row.table_name, row.check_name): row.violations for row in
             checks.constraint_report(stored, indoor.TABLES).collect()}
    assert len(found) > 30
    assert {key for key, count in found.items() if count} == set()
    sensors = {row.sensorName: row.networkID for row in stored["indoor_sensors"].collect()}
    assert sensors == {"Humidity - hall": 1, "Air": 1}
    assert "%" in {row.plotLabel for row in stored["indoor_plot_labels"].collect()}
    report = reports.indoor_report(stored, dt.datetime(2021, 3, 29, 12, 26, 9), dt.datetime(2021, 4, 1)).collect()
    assert [row.messageDate for row in report] == [dt.datetime(2021, 3, 30)] * 2


def test_indoor_settings_texts():
    parsed = indoor.IndoorSettings.from_text("Humidity, CO2", "rawData,dataValue", "%7c * |")
    assert (parsed.sensor_types, parsed.split_columns, parsed.delimiters) == (
        ["Humidity", "CO2"], ["rawData", "dataValue"], ["%7c", "|"])
    with pytest.raises(ValueError):
        indoor.IndoorSettings.from_text("Humidity", "rawData", "%7c**|")


def test_ignored_case_merges_spellings(spark, indoor_messages):
    loud = indoor_messages.withColumn("sensorName", F.upper("sensorName"))
    frames = indoor.build(indoor_messages.unionByName(loud), indoor.IndoorSettings(ignore_case=True))
    assert dimension_rows(frames["indoor_sensors"], indoor.TABLES["indoor_sensors"]).count() == 2


def test_pending_change_may_be_missing(indoor_messages):
    frames = indoor.build(indoor_messages.drop("pendingChange"))
    assert "indoor_pending_changes" not in frames and len(frames) == 9


def test_rest_lists(spark):
    messages = spark.createDataFrame([
        ("/Date(1604188800999)/", "1", "m1", "5"), ("/Date(1604188800000)/", "9", "m2", None), ("bad", "1", None, "5")],
        "MessageDate string, SensorID string, DataMessageGUID string, GatewayID string")
    sensors = spark.createDataFrame([("1", "7", "hall", "2"), ("3", "7", "unused", "2")], REST_SENSOR)
    gateways = spark.createDataFrame([("5", "11", "gw"), (None, "12", "nowhere")], REST_GATEWAY)
    found = {row.dataMessageGUID: row for row in indoor.from_rest(messages, sensors, gateways).collect()}
    assert set(found) == {"m1", "m2"}
    assert found["m1"].messageDate == dt.datetime(2020, 11, 1)
    assert (found["m1"].sensorName, found["m1"].networkID, found["m1"].gatewayName) == ("hall", "11", "gw")
    assert (found["m2"].sensorName, found["m2"].gatewayName) == (None, "nowhere")
    assert set(indoor.MESSAGE_NAMES) == set(REST_MESSAGE.names)


def _uplink(payload, receivers, **changes):
    message = {
        "received_at": "2021-03-29T12:26:09.848786419Z", "session_key_id": "k", "f_port": 1, "f_cnt": 9,
        "frm_payload": "AA==", "consumed_airtime": "0.061696s", "decoded_payload": payload, "rx_metadata": receivers,
        "settings": {"data_rate": {"lora": {"bandwidth": 125000, "spreading_factor": 7}}, "data_rate_index": 5,
                     "coding_rate": "4/5", "frequency": "868100000"}, **changes}
    return {
        "received_at": "2021-03-29T12:26:10.0Z", "correlation_ids": ["as:1", "gs:2"],
        "end_device_ids": {"device_id": "dev", "dev_eui": "e", "join_eui": "j", "dev_addr": "a",
                           "application_ids": {"application_id": "app"}},
        "uplink_message": {key: value for key, value in message.items() if value is not None}}


NEAR = {"gateway_ids": {"gateway_id": "near"}, "location": {"latitude": 53.48, "longitude": -2.24},
        "rssi": -80, "snr": 7.5, "time": "2021-03-29T12:26:09Z"}
FAR = {"gateway_ids": {"gateway_id": "broker"}, "uplink_token": "t2", "message_id": "m", "forwarder_net_id": 19,
       "packet_broker": {"sender_address": "s", "receiver_name": "r", "receiver_agent": "g",
                         "received_at": "2021-03-29T12:26:09.9Z", "forwarder_tenant_id": "tenant"}}
CURRENT = {"sensor_names": ["t", "h"], "sensor_data": [2.5, "wet", 9], "raw_bytes": "AQ"}
LEGACY = {"altitude": 1, "battery_voltage": 3.3, "humidity": 40, "pressure": 1000, "rain_detect": 0,
          "solar_voltage": 5, "temp": 20.5, "bytes": "Ag"}


@pytest.fixture(scope="module")
def uplinks(spark, tmp_path_factory):
    path = _write(
        tmp_path_factory.mktemp("uplink") / "landing",
        _uplink(CURRENT, [NEAR, FAR], decoded_payload_warnings=[]),
        _uplink(LEGACY, [{"gateway_ids": {"gateway_id": "near"}, "uplink_token": "t1",
                          "location": {"latitude": 1.0, "longitude": 2.0}}],
                decoded_payload_warnings=["low", "late"], f_cnt=10, consumed_airtime=None),
        _uplink({"other": 1}, [NEAR], f_cnt=11),
        _uplink({"sensor_names": ["a", "b"], "sensor_data": [1]}, [NEAR], f_cnt=12),
        _uplink(CURRENT, [], f_cnt=13),
        _uplink({"sensor_names": ["a"], "temp": 3}, [NEAR], f_cnt=14))
    return readable(read_documents(spark, path, UPLINK_DOCUMENT))


def test_uplink_rejects(uplinks):
    rejected = uplink.prepare(uplinks)[1]
    assert {row.uplink_message.f_cnt: row.reject_reason for row in rejected.collect()} == {
        "11": "no known payload", "12": "fewer values than names", "13": "no receivers"}


def test_uplink_tables(uplinks):
    frames = uplink.build(uplinks)
    assert set(frames) == set(uplink.TABLES)
    stored = {
        name: dimension_rows(frame, uplink.TABLES[name]) if uplink.TABLES[name].is_dimension else frame
        for name, frame in frames.items()}
    found = checks.constraint_report(stored, uplink.TABLES).filter("violations > 0").collect()
    assert [(row.table_name, row.check_name) for row in found] == []
    names = stored["uplink_sensors"].select("sensor_guid", "sensor_name")
    readings = stored["uplink_readings"].join(names, "sensor_guid").join(
        stored["uplink_uplinks"].select("uplink_guid", "f_cnt"), "uplink_guid").collect()
    values = {(row.f_cnt, row.sensor_name): row.sensor_value for row in readings}
    assert values[9, "t"] == "2.5" and values[9, "h"] == "wet" and values[10, "Rain Detect"] == "0"
    assert values[14, "Temperature"] == "3" and len(values) == 2 + 7 + 1
    rows = {row.f_cnt: row for row in stored["uplink_uplinks"].collect()}
    assert rows[9].consumed_airtime == 0.061696 and rows[10].consumed_airtime is None
    assert (rows[9].raw_bytes, rows[10].raw_bytes, rows[9].warning_guid) == ("AQ", "Ag", None)
    assert [row.decoded_payload_warning for row in stored["uplink_warnings"].collect()] == ['["low","late"]']
    broker = stored["uplink_rx"].filter("message_id = 'm'").first()
    assert (broker.forwarder_net_id, broker.forwarder_tenant_id) == (19, "tenant")
    assert stored["uplink_hops"].count() == 1 and stored["uplink_rx"].count() == 4
    assert sorted(row.uplink_token for row in stored["uplink_tokens"].collect()) == ["t1", "t2"]
    assert stored["uplink_locations"].count() == 2 and stored["uplink_gateways"].count() == 2
    times = {row.received_at for row in stored["uplink_datetimes"].filter("uplink_guid is not null").collect()}
    assert times == {dt.datetime(2021, 3, 29, 12, 26, 9, 848786)}


def test_first_receiver_mode(uplinks):
    frames = uplink.build(uplinks, rx_mode="first")
    rx = frames["uplink_rx"].join(frames["uplink_uplinks"].select("uplink_guid", "f_cnt"), "uplink_guid")
    row = rx.filter("f_cnt = 9").first()
    assert row.rssi == -80 and rx.count() == 3
    gateways = dimension_rows(frames["uplink_gateways"], uplink.TABLES["uplink_gateways"])
    assert gateways.filter(F.col("gateway_guid") == row.gateway_guid).first().gateway_name == "broker"
    assert {token.uplink_token for token in frames["uplink_tokens"].collect()} == {"t1", "t2"}
    assert frames["uplink_hops"].join(frames["uplink_rx"], "rx_guid").count() == 1
    with pytest.raises(ValueError):
        uplink.tables(uplinks, rx_mode="last")


def _block(**changes):
    return {
        "mode": 1, "last_update": "2021-03-29 12:00:00",
        "analogs": [{"aid": "1", "name": "flow", "units": "l", "value": 2.5, "recharge": "0", "cycle_pulses": "1",
                     "start": "0", "stop": "10", "dp": "2"}],
        "outputs": [{"oid": "1", "name": "valve", "mode": 2, "status": 3, "high_state": "on", "low_state": "off",
                     "last_update": None}],
        "alarms": [{"aid": "1", "name": "leak", "type": 4, "status": 5, "pulse_units": "p", "healthy_name": "ok",
                    "faulty_name": "no", "pulse_total": "1.5", "last_change": "2021-03-29 11:00:00"}], **changes}


@pytest.fixture(scope="module")
def polls(spark, tmp_path_factory):
    def poll(unit, blocks, now="2021-03-29T13:00:00+01:00", last_update=None):
        return {"unit": {"id": unit, "name": f"unit {unit}"}, "document": {
            "success": True, "message": "ok", "now": now,
            "details": {"name": "d", "tz": "Europe/London", "update_cycle": 15, "last_update": last_update},
            "blocks": blocks}}
    path = _write(
        tmp_path_factory.mktemp("water") / "landing",
        poll(1, [_block(), _block(analogs=[])]), poll(2, [_block(analogs=[], last_update=None)], "2021-03-29T13:00:00+0100",
                                                      "2021-03-29 10:00:00"),
        {"unit": {"id": 3, "name": "unit 3"}, "document": None}, poll(4, []))
    return readable(read_documents(spark, path, WATER_POLL))


def test_water_tables(polls):
    assert sorted(row.reject_reason for row in water.prepare(polls)[1].collect()) == ["no block", "no document"]
    frames = water.build(polls)
    assert set(frames) == set(water.TABLES)
    stored = {
        name: dimension_rows(frame, water.TABLES[name]) if water.TABLES[name].is_dimension else frame
        for name, frame in frames.items()}
    found = checks.constraint_report(stored, water.TABLES).filter("violations > 0").collect()
    assert [(row.table_name, row.check_name) for row in found] == []
    assert {name: frame.count() for name, frame in stored.items()} == {
        "water_units": 2, "water_modes": 2, "water_statuses": 2, "water_types": 1, "water_measure_units": 2,
        "water_sensors": 1, "water_requests": 2, "water_readings": 1, "water_outputs": 2, "water_alarms": 2,
        "water_updates": 4}
    assert {row.requestNow for row in stored["water_requests"].collect()} == {dt.datetime(2021, 3, 29, 12)}
    report = reports.water_report(stored, sensor="flow", unit="unit 1").collect()
    assert [(row.readingValue, row.mUnitName, row.lastUpdate) for row in report] == [
        ("2.5", "l", dt.datetime(2021, 3, 29, 12))]
    zoned = water.tables(water.prepare(polls)[0], use_unit_zone=True)["water_updates"]
    assert {row.lastUpdate for row in zoned.filter("readingGUID is not null").collect()} == {
        dt.datetime(2021, 3, 29, 11)}


def test_history(spark):
    wide = spark.createDataFrame(
        [(1, 10, "2021-01-01 00:00:00", 1.5, None, 3.0), (2, 99, "2021-01-01 00:00:00", 1.0, 2.0, 3.0)],
        "ID int, INTERFACE_ID int, DATETIME string, AI1 double, AI2 double, AI3 double")
    units = spark.createDataFrame([("u10", 10, "ten")], "unitGUID string, unitID int, unitName string")
    catalogue = spark.createDataFrame(
        [("s1", "u10", 1, "m1", "flow"), ("s2", "u10", 1, "m1", "flow two"), ("s3", "u10", 2, "m1", "level")],
        "sensorGUID string, unitGUID string, analogID int, mUnitGUID string, sensorName string")
    names = spark.createDataFrame([("m1", "l")], "mUnitGUID string, mUnitName string")
    long = water.long_history(wide)
    assert long.count() == 6
    joined = water.rekey_history(long, units, catalogue, names).collect()
    assert sorted((row.analogID, row.sensorName, row.readingValue) for row in joined) == [
        (1, "flow", 1.5), (1, "flow two", 1.5), (2, "level", None)]
    frames, rejected = water.load_history(long, units, catalogue)
    assert sorted((row.analogID, row.sensorGUID, row.mUnitGUID) for row in frames["water_readings"].collect()) == [
        (1, "s1", "m1"), (2, "s3", "m1"), (3, None, None)]
    assert frames["water_updates"].count() == 3 and rejected.count() == 3


def test_batch_load_twice_changes_nothing(spark, indoor_messages, tmp_path):
    root, staging = str(tmp_path / "tables"), str(tmp_path / "staging")

    def load(batch, messages):
        return load_batch(messages, indoor.prepare, indoor.tables, indoor.TABLES, root, batch, staging)

    def counts():
        return {name: read_table(spark, root, spec).count() for name, spec in indoor.TABLES.items()}

    assert set(counts().values()) == {0}
    assert load("one", indoor_messages).count() == 3
    first = counts()
    assert first["indoor_readings"] == first["indoor_signal_status"] > 0
    load("one", indoor_messages)
    assert counts() == first
    load("two", indoor_messages)
    assert counts() == first
    readings = read_table(spark, root, indoor.TABLES["indoor_readings"])
    assert readings.count() == readings.select("readingID").distinct().count()
    assert {row["batch"] for row in readings.select("batch").distinct().collect()} == {"one"}


def test_a_replay_with_fewer_days_leaves_nothing_stale(spark, indoor_messages, tmp_path):
    root, staging = str(tmp_path / "tables"), str(tmp_path / "staging")
    for messages in (indoor_messages, indoor_messages.filter("messageDate < '2021-03-30'")):
        load_batch(messages, indoor.prepare, indoor.tables, indoor.TABLES, root, "one", staging)
    for name in ("indoor_readings", "indoor_sensor_voltage"):
        days = {str(row["day"]) for row in read_table(spark, root, indoor.TABLES[name]).select("day").distinct().collect()}
        assert days == {"2021-03-29"}


def test_staged_polls_give_the_same_rows_and_rejects(spark, polls, tmp_path):
    """Polls that are judged and cut before they are written are written once; nothing else changes."""
    found = {}
    for name, stage in (("plain", None), ("staged", water.stage)):
        root, staging = str(tmp_path / name), str(tmp_path / f"staging {name}")
        rejected = load_batch(polls, water.prepare, water.tables, water.TABLES, root, "one", staging, stage)
        rows = {table: sorted(map(str, read_table(spark, root, spec).collect())) for table, spec in water.TABLES.items()}
        found[name] = rejected.columns, sorted(map(str, rejected.collect())), rows
        assert sorted(os.listdir(f"{staging}/one")) == (["documents"] if stage else ["accepted", "documents"])
    assert found["plain"] == found["staged"] and len(found["plain"][1]) == 2


def test_plain_timestamps_are_those_of_the_pattern(spark):
    texts = ["2021-01-01 00:00:00", "2021-02-30 00:00:00", "2021-01-01T00:00:00", "2021-01-01 00:00:5 ", "2021-01-01 00:00:00\n",
             " 2021-01-01 00:00:00", "0000-01-01 00:00:00", "2021-01-01 24:00:00", "2021-01-01 00:00:0Z", "bad", "", None]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    pattern = F.try_to_timestamp("text", F.lit("yyyy-MM-dd HH:mm:ss")).cast("string")
    rows = frame.select("text", plain_timestamp(F.col("text")).cast("string").alias("found"), pattern.alias("wanted")).collect()
    assert [row.found for row in rows] == [row.wanted for row in rows]
    assert rows[0].found == "2021-01-01 00:00:00" and rows[2].found is None


def test_unit_files_are_made_by_several_tasks_and_listed_by_few(spark, tmp_path, monkeypatch):
    """One task made the files of all units, and each of their folders was listed by a task of its own."""
    from bindings import water_feed
    from sensorloom.sources import documents

    rows = [(i, f"s {i}", i % 3 + 6, float(i % 5 - 1)) for i in range(1, 41)] + [(7, "s 7", 7, 1.0), (50, None, None, None)]
    frame = spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    frame.coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    made, asked, read = {}, [], documents.read_documents
    monkeypatch.setattr(water_feed, "shared_folder", lambda _, name: made.setdefault(name, str(tmp_path / name)))
    monkeypatch.setattr(documents, "read_documents", lambda *some, **more: asked.append(spark.conf.get(documents.LISTING)) or read(*some, **more))
    before = spark.conf.get(documents.LISTING)
    monkeypatch.setattr(documents, "LISTING_TASKS", 5)
    found = sorted(map(tuple, water_feed.water_from_unit_lists(spark, str(tmp_path)).collect()), key=str)
    assert asked == ["5", "5"] and spark.conf.get(documents.LISTING) == before
    files = [path for path in (tmp_path / "documents").rglob("part-*.json")]
    units = {(i, nation) for i, _, nation, balance in rows if balance is not None and balance >= 0}
    strays = {(-i, 7) for i, _, nation, _ in rows if nation == 7}
    assert {(path.parent.parent.name, path.parent.name) for path in files} == {(f"poll={n}", f"unit={i}") for i, n in units | strays}
    assert len(files) == len(units | strays) and len({path.name.split("-")[1] for path in files}) > 5
    wanted = {(i, name, "no document" if balance < 0 else "stored") for i, name, nation, balance in rows if nation is not None}
    assert {row for row in found if row[0] < 50 and row[2] != "unit in no list"} == wanted
    assert {row[0] for row in found if row[2] == "unit in no list"} == {i for i, _ in strays}
