"""Schemas of the payloads that arrive in the landing folder.

An absent key reads as NULL.  Senders quote numbers or not as they like, so numbers are read as
text and converted by the plans; a typed reader would give up the whole record.
"""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "array<string>": T.ArrayType(T.StringType()),
}


def _struct(*fields: tuple[str, T.DataType | str]) -> T.StructType:
    return T.StructType([
        T.StructField(name, _KINDS[kind] if isinstance(kind, str) else kind) for name, kind in fields])


def schema_of(columns: str) -> T.StructType:
    """``'a int, b string'`` -> schema, without a running session."""
    return _struct(*[tuple(column.split()) for column in columns.split(",")])


# Indoor sensors: element of ``sensorMessages``, also the columns of the history export.
INDOOR_MESSAGE = _struct(
    ("dataMessageGUID", "string"), ("sensorName", "string"), ("networkID", "string"), ("applicationID", "string"),
    ("rawData", "string"), ("dataValue", "string"), ("dataType", "string"), ("plotLabels", "string"),
    ("plotValues", "string"), ("messageDate", "string"), ("signalStrength", "string"), ("voltage", "string"),
    ("batteryLevel", "string"), ("pendingChange", "string"),
)

# Indoor sensors: elements of the REST lists.  Fields that the load never uses are not read.
REST_MESSAGE = _struct(
    ("MessageDate", "string"), ("SensorID", "string"), ("DataMessageGUID", "string"), ("State", "string"),
    ("SignalStrength", "string"), ("Voltage", "string"), ("Battery", "string"), ("Data", "string"),
    ("DisplayData", "string"), ("PlotValue", "string"), ("MetNotificationRequirements", "string"),
    ("GatewayID", "string"), ("DataValues", "string"), ("DataTypes", "string"), ("PlotValues", "string"),
    ("PlotLabels", "string"),
)
REST_SENSOR = _struct(
    ("SensorID", "string"), ("ApplicationID", "string"), ("SensorName", "string"), ("AccountID", "string"))
REST_GATEWAY = _struct(("GatewayID", "string"), ("NetworkID", "string"), ("Name", "string"))

# LoRaWAN uplinks.
_FORWARDING = (
    ("message_id", "string"),
    ("forwarder_net_id", "string"), ("forwarder_tenant_id", "string"), ("forwarder_cluster_id", "string"),
    ("home_network_net_id", "string"), ("home_network_tenant_id", "string"), ("home_network_cluster_id", "string"),
)
LEGACY_FIELDS = {
    # Payload field -> sensor name.
    "altitude": "Altitude",
    "battery_voltage": "Battery Voltage",
    "humidity": "Humidity",
    "pressure": "Pressure",
    "rain_detect": "Rain Detect",
    "solar_voltage": "Solar Voltage",
    "temp": "Temperature",
}
RECEIVER = _struct(
    ("gateway_ids", _struct(("gateway_id", "string"))),
    ("location", _struct(("latitude", "string"), ("longitude", "string"), ("source", "string"))),
    ("time", "string"), ("timestamp", "string"), ("rssi", "string"), ("channel_rssi", "string"), ("snr", "string"),
    ("uplink_token", "string"), *_FORWARDING,
    ("packet_broker", _struct(
        ("sender_address", "string"), ("receiver_name", "string"), ("receiver_agent", "string"),
        ("received_at", "string"), *_FORWARDING)),
)
UPLINK_DOCUMENT = _struct(
    ("received_at", "string"),
    ("correlation_ids", "array<string>"),
    ("end_device_ids", _struct(
        ("device_id", "string"), ("dev_eui", "string"), ("join_eui", "string"), ("dev_addr", "string"),
        ("application_ids", _struct(("application_id", "string"))))),
    ("uplink_message", _struct(
        ("received_at", "string"), ("session_key_id", "string"), ("f_port", "string"), ("f_cnt", "string"),
        ("frm_payload", "string"), ("consumed_airtime", "string"),
        ("decoded_payload_warnings", "array<string>"),
        ("decoded_payload", _struct(
            ("sensor_names", "array<string>"), ("sensor_data", "array<string>"),
            ("raw_bytes", "string"), ("bytes", "string"),
            *[(field, "string") for field in LEGACY_FIELDS])),
        ("rx_metadata", T.ArrayType(RECEIVER)),
        ("settings", _struct(
            ("data_rate", _struct(("lora", _struct(("bandwidth", "string"), ("spreading_factor", "string"))))),
            ("data_rate_index", "string"), ("coding_rate", "string"), ("frequency", "string"),
            ("timestamp", "string"))))),
)

# Water controllers: the polled document together with the unit it was polled for.
WATER_UNIT = _struct(("id", "string"), ("name", "string"))
WATER_DOCUMENT = _struct(
    ("success", "string"), ("message", "string"), ("now", "string"),
    ("details", _struct(("name", "string"), ("tz", "string"), ("update_cycle", "string"), ("last_update", "string"))),
    ("blocks", T.ArrayType(_struct(
        ("mode", "string"), ("last_update", "string"),
        ("analogs", T.ArrayType(_struct(
            ("aid", "string"), ("name", "string"), ("units", "string"), ("value", "string"), ("recharge", "string"),
            ("cycle_pulses", "string"), ("start", "string"), ("stop", "string"), ("dp", "string")))),
        ("outputs", T.ArrayType(_struct(
            ("oid", "string"), ("name", "string"), ("mode", "string"), ("status", "string"), ("high_state", "string"),
            ("low_state", "string"), ("last_update", "string")))),
        ("alarms", T.ArrayType(_struct(
            ("aid", "string"), ("name", "string"), ("type", "string"), ("status", "string"), ("pulse_units", "string"),
            ("healthy_name", "string"), ("faulty_name", "string"), ("pulse_total", "string"),
            ("last_change", "string")))),
    ))),
)
WATER_POLL = _struct(("unit", WATER_UNIT), ("document", WATER_DOCUMENT))
