"""LoRaWAN uplink documents: one nested document becomes rows of fourteen tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.functions.keys import surrogate_key
from sensorloom.functions.temporal import iso_timestamp
from sensorloom.functions.text import drop_last
from sensorloom.operators.clean import split_rejects, with_reject_reason
from sensorloom.operators.filters import first_present, non_empty
from sensorloom.operators.reshape import first_of, labelled_fields, last_where, zip_names_values
from sensorloom.sources.schemas import LEGACY_FIELDS
from sensorloom.sources.tables import Table

FORWARDING = (
    "forwarder_net_id", "forwarder_tenant_id", "forwarder_cluster_id",
    "home_network_net_id", "home_network_tenant_id", "home_network_cluster_id")
NUMERIC_FORWARDING = ("forwarder_net_id", "home_network_net_id")


def _ref(column: str, table: str) -> tuple[tuple[str, ...], str, tuple[str, ...]]:
    return (column,), table, (column,)


TABLES = {table.name: table for table in (
    Table("uplink_applications", "application_guid string, application_name string",
          natural_key=("application_name",), generated_id="application_guid", primary_key=("application_guid",),
          required=("application_guid", "application_name"), max_length={"application_name": 35}),
    Table("uplink_warnings", "warning_guid string, decoded_payload_warning string",
          natural_key=("decoded_payload_warning",), generated_id="warning_guid", primary_key=("warning_guid",)),
    Table("uplink_locations", "location_guid string, latitude double, longitude double, source string",
          natural_key=("latitude", "longitude", "source"), generated_id="location_guid",
          primary_key=("location_guid",), required=("location_guid", "latitude", "longitude"),
          max_length={"source": 100}),
    Table("uplink_gateways", "gateway_guid string, location_guid string, gateway_name string",
          natural_key=("gateway_name",), generated_id="gateway_guid", primary_key=("gateway_guid",),
          required=("gateway_guid", "gateway_name"), max_length={"gateway_name": 30},
          references=(_ref("location_guid", "uplink_locations"),)),
    Table("uplink_sensors",
          "sensor_guid string, sensor_name string, sensor_type string, sensor_location string, "
          "measurement_unit string",
          natural_key=("sensor_name",), generated_id="sensor_guid", primary_key=("sensor_guid",),
          max_length={"sensor_name": 30, "sensor_type": 15, "sensor_location": 30, "measurement_unit": 5}),
    Table("uplink_devices",
          "device_guid string, application_guid string, device_name string, device_location string, "
          "dev_eui string, join_eui string, dev_addr string",
          natural_key=("device_name",), generated_id="device_guid", primary_key=("device_guid",),
          required=("device_guid", "application_guid", "device_name"),
          max_length={"device_name": 100, "device_location": 30, "dev_eui": 30, "join_eui": 30, "dev_addr": 15},
          references=(_ref("application_guid", "uplink_applications"),)),
    Table("uplink_uplinks",
          "uplink_guid string, device_guid string, warning_guid string, session_key_id string, f_port int, "
          "f_cnt int, frm_payload string, raw_bytes string, consumed_airtime double",
          primary_key=("uplink_guid",), required=("uplink_guid", "device_guid"),
          max_length={"session_key_id": 40, "frm_payload": 50, "raw_bytes": 50},
          references=(_ref("device_guid", "uplink_devices"), _ref("warning_guid", "uplink_warnings"))),
    Table("uplink_rx",
          "rx_guid string, gateway_guid string, uplink_guid string, rx_time timestamp, rx_timestamp bigint, "
          "rssi int, channel_rssi int, snr double, message_id string, forwarder_net_id int, "
          "forwarder_tenant_id string, forwarder_cluster_id string, home_network_net_id int, "
          "home_network_tenant_id string, home_network_cluster_id string",
          primary_key=("rx_guid",), day_of="rx_received_at", required=("rx_guid", "uplink_guid"),
          max_length={"message_id": 30, "forwarder_tenant_id": 8, "forwarder_cluster_id": 15,
                      "home_network_tenant_id": 8, "home_network_cluster_id": 12},
          references=(_ref("gateway_guid", "uplink_gateways"), _ref("uplink_guid", "uplink_uplinks"))),
    Table("uplink_hops",
          "hop_guid string, rx_guid string, sender_address string, receiver_name string, receiver_agent string",
          primary_key=("hop_guid",), required=("hop_guid", "rx_guid"),
          max_length={"sender_address": 15, "receiver_name": 40, "receiver_agent": 40},
          references=(_ref("rx_guid", "uplink_rx"),)),
    Table("uplink_datetimes", "rx_guid string, hop_guid string, uplink_guid string, received_at timestamp",
          required=("received_at",), one_parent_of=("rx_guid", "hop_guid", "uplink_guid"),
          one_for=("rx_guid", "hop_guid", "uplink_guid"), day_of="received_at",
          references=(_ref("rx_guid", "uplink_rx"), _ref("hop_guid", "uplink_hops"),
                      _ref("uplink_guid", "uplink_uplinks"))),
    Table("uplink_correlation_ids", "correlation_guid string, rx_guid string, correlation_id string",
          primary_key=("correlation_guid",), required=("correlation_guid", "rx_guid", "correlation_id"),
          references=(_ref("rx_guid", "uplink_rx"),)),
    Table("uplink_tokens", "rx_guid string, gateway_guid string, uplink_token string",
          required=("rx_guid", "uplink_token"), one_for=("rx_guid",),
          references=(_ref("rx_guid", "uplink_rx"), _ref("gateway_guid", "uplink_gateways"))),
    Table("uplink_readings", "uplink_guid string, sensor_guid string, sensor_value string",
          required=("uplink_guid", "sensor_guid"), day_of="uplink_received_at",
          references=(_ref("uplink_guid", "uplink_uplinks"), _ref("sensor_guid", "uplink_sensors"))),
    Table("uplink_settings",
          "uplink_setting_guid string, uplink_guid string, bandwidth int, spreading_factor int, "
          "data_rate_index int, coding_rate string, frequency bigint, setting_timestamp bigint",
          primary_key=("uplink_setting_guid",), required=("uplink_setting_guid", "uplink_guid"),
          max_length={"coding_rate": 5}, references=(_ref("uplink_guid", "uplink_uplinks"),)),
)}


def is_current(payload: Column) -> Column:
    """Payloads of the current generation carry both a list of names and a list of values."""
    return payload.getField("sensor_names").isNotNull() & payload.getField("sensor_data").isNotNull()


def payload_readings(payload: Column) -> Column:
    """(name, value) pairs of either payload generation."""
    legacy = F.filter(labelled_fields(LEGACY_FIELDS, payload), lambda pair: pair.getField("value").isNotNull())
    current = zip_names_values(payload.getField("sensor_names"), payload.getField("sensor_data"))
    return F.when(is_current(payload), current).otherwise(legacy)


def prepare(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, rejected documents)."""
    payload = F.col("uplink_message.decoded_payload")
    names, data = payload.getField("sensor_names"), payload.getField("sensor_data")
    no_legacy = F.coalesce(*[payload.getField(name) for name in LEGACY_FIELDS]).isNull()
    judged = with_reject_reason(documents, {
        "no device": F.col("end_device_ids.device_id").isNull(),
        "no receivers": F.coalesce(F.size("uplink_message.rx_metadata"), F.lit(0)) < 1,
        "fewer values than names": is_current(payload) & (F.size(data) < F.size(names)),
        "no known payload": ~F.coalesce(is_current(payload), F.lit(False)) & no_legacy,
    })
    return split_rejects(judged)


def _uplinks(documents: DataFrame) -> DataFrame:
    """One flat row per document, with its ids and lists.  ``receivers`` carry their position."""
    message = F.col("uplink_message")
    payload = message.getField("decoded_payload")
    warnings = non_empty(message.getField("decoded_payload_warnings"))
    airtime = message.getField("consumed_airtime")
    flat = documents.select(
        F.col("end_device_ids.application_ids.application_id").alias("application_name"),
        F.col("end_device_ids.device_id").alias("device_name"),
        F.col("end_device_ids.dev_eui"), F.col("end_device_ids.join_eui"), F.col("end_device_ids.dev_addr"),
        F.to_json(warnings).alias("decoded_payload_warning"),
        message.getField("session_key_id").alias("session_key_id"),
        message.getField("f_port").try_cast("int").alias("f_port"),
        message.getField("f_cnt").try_cast("int").alias("f_cnt"),
        message.getField("frm_payload").alias("frm_payload"),
        first_present(payload.getField("raw_bytes"), payload.getField("bytes")).alias("raw_bytes"),
        drop_last(airtime, 1).try_cast("double").alias("consumed_airtime"),
        iso_timestamp(message.getField("received_at")).alias("uplink_received_at"),
        iso_timestamp(F.col("received_at")).alias("rx_received_at"),
        message.getField("settings").alias("settings"),
        message.getField("rx_metadata").alias("receivers"),
        F.col("correlation_ids"),
        payload_readings(payload).alias("readings"),
        message.getField("received_at").alias("_received_text"),
    )
    return flat.withColumns({
        "application_guid": surrogate_key("uplink_applications", "application_name"),
        "device_guid": surrogate_key("uplink_devices", "device_name"),
        "warning_guid": surrogate_key(
            "uplink_warnings", "decoded_payload_warning", where=F.col("decoded_payload_warning").isNotNull()),
        "uplink_guid": surrogate_key(
            "uplink_uplinks", "device_name", "session_key_id", "f_port", "f_cnt", "frm_payload", "_received_text"),
        "_seen_at": F.col("rx_received_at"),
    }).withColumn("_seen_id", F.col("uplink_guid")).drop("_received_text")


def _number(struct: Column, name: str, kind: str = "double") -> Column:
    return struct.getField(name).try_cast(kind)


def _location_guid(receiver: Column) -> Column:
    place = receiver.getField("location")
    return surrogate_key(
        "uplink_locations", _number(place, "latitude"), _number(place, "longitude"), place.getField("source"),
        where=place.isNotNull())


def _gateway_guid(receiver: Column) -> Column:
    name = receiver.getField("gateway_ids").getField("gateway_id")
    return surrogate_key("uplink_gateways", name, where=name.isNotNull())


def _receivers(uplinks: DataFrame) -> DataFrame:
    keep = ("uplink_guid", "rx_received_at", "_seen_at", "_seen_id")
    return uplinks.select(*keep, F.posexplode("receivers").alias("pos", "rx")).withColumns({
        "rx_guid": surrogate_key("uplink_rx", "uplink_guid", "pos"),
        "gateway_guid": _gateway_guid(F.col("rx")),
    })


def _first_receivers(uplinks: DataFrame) -> DataFrame:
    """Parity form: one row per uplink with the metrics of its first receiver, the gateway of the
    last receiver that names one, and the first of the leading two tokens."""
    receivers = F.col("receivers")
    last = last_where(receivers, lambda rx: rx.getField("gateway_ids").isNotNull())
    return uplinks.select(
        "uplink_guid", "rx_received_at", "_seen_at", "_seen_id", F.lit(0).alias("pos"),
        surrogate_key("uplink_rx", "uplink_guid", F.lit(0)).alias("rx_guid"),
        _gateway_guid(last).alias("gateway_guid"),
        first_of(receivers).withField("uplink_token", F.coalesce(
            first_of(receivers).getField("uplink_token"),
            F.get(receivers, F.lit(1)).getField("uplink_token"))).alias("rx"),
    )


def _forwarding(receiver: Column, name: str) -> Column:
    """Forwarder fields stand beside or inside the packet-broker struct."""
    value = F.coalesce(receiver.getField(name), receiver.getField("packet_broker").getField(name))
    return (value.try_cast("int") if name in NUMERIC_FORWARDING else value).alias(name)


def tables(documents: DataFrame, rx_mode: str = "all") -> dict[str, DataFrame]:
    """Accepted documents as rows of the stored tables.

    ``rx_mode='all'`` stores each receiver with its own gateway; ``'first'`` stores one per uplink.
    """
    if rx_mode not in ("all", "first"):
        raise ValueError(f"rx_mode is 'all' or 'first', not {rx_mode!r}")
    uplinks = _uplinks(documents)
    every = _receivers(uplinks)
    stored = every if rx_mode == "all" else _first_receivers(uplinks)
    seen = ("_seen_at", "_seen_id")
    rx = F.col("rx")
    first_rx = stored.filter("pos = 0")
    hop_parent = F.col("rx_guid") if rx_mode == "all" else surrogate_key("uplink_rx", "uplink_guid", F.lit(0))
    hops = every.filter(rx.getField("packet_broker").isNotNull()).withColumn("rx_guid", hop_parent).withColumn(
        "hop_guid", surrogate_key("uplink_hops", "rx_guid", "pos"))
    hop = rx.getField("packet_broker")
    nothing = F.lit(None).cast("string")
    place = rx.getField("location")
    lora = F.col("settings.data_rate.lora")
    readings = uplinks.select("uplink_guid", "uplink_received_at", F.inline("readings")).withColumnsRenamed(
        {"name": "sensor_name", "value": "sensor_value"})
    return {
        "uplink_applications": uplinks.select("application_name"),
        "uplink_warnings": uplinks.filter("warning_guid IS NOT NULL").select("decoded_payload_warning"),
        "uplink_locations": every.filter(place.isNotNull()).select(
            _number(place, "latitude").alias("latitude"), _number(place, "longitude").alias("longitude"),
            place.getField("source").alias("source")),
        "uplink_gateways": every.filter("gateway_guid IS NOT NULL").select(
            rx.getField("gateway_ids").getField("gateway_id").alias("gateway_name"),
            _location_guid(rx).alias("location_guid"), *seen),
        "uplink_sensors": readings.select("sensor_name"),
        "uplink_devices": uplinks.select(
            "device_name", "application_guid", "dev_eui", "join_eui", "dev_addr", *seen),
        "uplink_uplinks": uplinks.select(*TABLES["uplink_uplinks"].schema.names),
        "uplink_rx": stored.select(
            "rx_guid", "gateway_guid", "uplink_guid",
            iso_timestamp(rx.getField("time")).alias("rx_time"),
            _number(rx, "timestamp", "bigint").alias("rx_timestamp"), _number(rx, "rssi", "int").alias("rssi"),
            _number(rx, "channel_rssi", "int").alias("channel_rssi"), _number(rx, "snr").alias("snr"),
            F.coalesce(rx.getField("message_id"), hop.getField("message_id")).alias("message_id"),
            *[_forwarding(rx, name) for name in FORWARDING], "rx_received_at"),
        "uplink_hops": hops.select(
            "hop_guid", "rx_guid", hop.getField("sender_address").alias("sender_address"),
            hop.getField("receiver_name").alias("receiver_name"),
            hop.getField("receiver_agent").alias("receiver_agent")),
        "uplink_datetimes": (
            first_rx.select("rx_guid", nothing.alias("hop_guid"), nothing.alias("uplink_guid"),
                            F.col("rx_received_at").alias("received_at"))
            .unionByName(hops.select(nothing.alias("rx_guid"), "hop_guid", nothing.alias("uplink_guid"),
                                     iso_timestamp(hop.getField("received_at")).alias("received_at")))
            .unionByName(uplinks.select(nothing.alias("rx_guid"), nothing.alias("hop_guid"), "uplink_guid",
                                        F.col("uplink_received_at").alias("received_at")))
            .filter("received_at IS NOT NULL")),
        "uplink_correlation_ids": uplinks.select(
            surrogate_key("uplink_rx", "uplink_guid", F.lit(0)).alias("rx_guid"),
            F.posexplode("correlation_ids").alias("pos", "correlation_id")).select(
                surrogate_key("uplink_correlation_ids", "rx_guid", "pos", "correlation_id").alias("correlation_guid"),
                "rx_guid", "correlation_id"),
        "uplink_tokens": stored.filter(rx.getField("uplink_token").isNotNull()).select(
            "rx_guid", "gateway_guid", rx.getField("uplink_token").alias("uplink_token")),
        "uplink_readings": readings.select(
            "uplink_guid", surrogate_key("uplink_sensors", "sensor_name").alias("sensor_guid"), "sensor_value",
            "uplink_received_at"),
        "uplink_settings": uplinks.filter(F.col("settings").isNotNull()).select(
            surrogate_key("uplink_settings", "uplink_guid").alias("uplink_setting_guid"), "uplink_guid",
            _number(lora, "bandwidth", "int").alias("bandwidth"),
            _number(lora, "spreading_factor", "int").alias("spreading_factor"),
            _number(F.col("settings"), "data_rate_index", "int").alias("data_rate_index"),
            F.col("settings.coding_rate"), _number(F.col("settings"), "frequency", "bigint").alias("frequency"),
            _number(F.col("settings"), "timestamp", "bigint").alias("setting_timestamp")),
    }


def build(documents: DataFrame, rx_mode: str = "all") -> dict[str, DataFrame]:
    """Documents straight to table rows, rejected ones left out."""
    return tables(prepare(documents)[0], rx_mode)
