"""The uplink feed: events as nested documents, then its fourteen tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindings.registry import guid, landed, query, table
from sensorloom.plans import uplink
from sensorloom.sources.documents import read_documents, readable
from sensorloom.sources.schemas import UPLINK_DOCUMENT
from sensorloom.sources.tables import dimension_rows

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def documents(spark, sf_dir) -> DataFrame:
    """Uplink documents that landed as JSON."""
    folder = landed(spark, sf_dir, "uplink", "events", _events_as_documents)
    return readable(read_documents(spark, folder, UPLINK_DOCUMENT))


def _events_as_documents(events: DataFrame) -> DataFrame:
    """Clicks are heard by two gateways, views by none; signups have too few values; purchases use
    the older payload."""
    kind, user, event = F.col("event_type"), F.col("user_id"), F.col("event_id")
    user_text, event_text = user.cast("string"), event.cast("string")
    level = F.regexp_extract("props", "([0-9]+)", 1)

    def given(condition, value):
        return F.when(condition, value)

    click, purchase, error = kind == "click", kind == "purchase", kind == "error"
    plain = F.struct(
        F.struct(F.concat(F.lit("gw-"), user_text).alias("gateway_id")).alias("gateway_ids"),
        given(purchase, event).alias("timestamp"), user.cast("int").alias("rssi"))
    near = F.struct(
        F.struct(F.lit("near").alias("gateway_id")).alias("gateway_ids"),
        F.struct((user + 0.5).alias("latitude"), (level.cast("int") + 0.25).alias("longitude")).alias("location"),
        F.date_format("ts", ISO).alias("time"), event.alias("timestamp"), user.cast("int").alias("rssi"))
    far = F.struct(
        F.struct(F.concat(F.lit("far-"), level).alias("gateway_id")).alias("gateway_ids"),
        F.concat(F.lit("token-"), event_text).alias("uplink_token"),
        F.struct(F.lit("a").alias("sender_address"), F.lit("b").alias("receiver_name"),
                 F.lit("c").alias("receiver_agent"), F.date_format("ts", ISO).alias("received_at"),
                 F.lit("19").alias("forwarder_net_id")).alias("packet_broker"))
    # The receivers differ in their keys, so each is written as text under the full schema.
    shape = UPLINK_DOCUMENT["uplink_message"].dataType["rx_metadata"].dataType
    receivers = (
        F.when(click, F.concat_ws(",", F.to_json(near), F.to_json(far)))
        .when(kind == "view", F.lit("")).otherwise(F.to_json(plain)))
    rx = F.from_json(F.concat(F.lit("["), receivers, F.lit("]")), shape)
    current = kind.isin("click", "signup", "view")
    payload = F.struct(
        given(current, F.array(F.lit("temp"), F.lit("hum"))).when(error, F.array(F.lit("state"))).alias("sensor_names"),
        given(click | (kind == "view"), F.array(user_text, level, F.lit("extra")))
        .when(kind == "signup", F.array(user_text)).when(error, F.array(F.lit("on"))).alias("sensor_data"),
        given(click, event_text).alias("raw_bytes"), given(error, user_text).alias("bytes"),
        *[given(purchase & F.lit(field in ("altitude", "temp")), level if field == "altitude" else user_text)
          .alias(field) for field in uplink.LEGACY_FIELDS])
    return events.select(
        F.date_format(F.col("ts") + F.expr("interval 1 second"), ISO).alias("received_at"),
        F.array(F.concat(F.lit("as:"), event_text), F.lit("gs")).alias("correlation_ids"),
        F.struct(
            F.concat(F.lit("dev-"), user_text).alias("device_id"), F.concat(F.lit("eui-"), kind).alias("dev_eui"),
            F.lit(None).cast("string").alias("join_eui"), user_text.alias("dev_addr"),
            F.struct(kind.alias("application_id")).alias("application_ids")).alias("end_device_ids"),
        F.struct(
            F.date_format("ts", ISO).alias("received_at"), event_text.alias("session_key_id"),
            level.cast("int").alias("f_port"), event.cast("int").alias("f_cnt"),
            given(~purchase, F.concat(F.lit("p"), event_text)).alias("frm_payload"),
            given(~error, F.concat(user_text, F.lit(".5s"))).alias("consumed_airtime"),
            given(error, F.array(F.lit("low battery"))).when(click, F.array().cast("array<string>"))
            .alias("decoded_payload_warnings"),
            payload.alias("decoded_payload"), rx.alias("rx_metadata"),
            F.struct(
                F.struct(F.struct(F.lit(125000).alias("bandwidth"), F.lit(7).alias("spreading_factor")).alias("lora"))
                .alias("data_rate"),
                F.lit(5).alias("data_rate_index"), F.lit("4/5").alias("coding_rate"),
                (user + 868100000).alias("frequency"), given(~error, event).alias("timestamp")).alias("settings"),
        ).alias("uplink_message"))


UPLINKS_SQL = f"""
  base AS (
    SELECT event_id, user_id, event_type, ts, regexp_extract(props, '([0-9]+)', 1) AS k,
           'dev-' || user_id AS device_name, cast(event_id AS varchar) AS session_key_id,
           CASE WHEN event_type <> 'purchase' THEN 'p' || event_id END AS frm_payload
    FROM events WHERE event_type IN ('click', 'purchase', 'error')),
  up AS (
    SELECT *, {guid('uplink_applications', 'event_type')} AS application_guid,
           {guid('uplink_devices', 'device_name')} AS device_guid,
           {guid('uplink_uplinks', 'device_name', 'session_key_id', 'cast(k AS integer)', 'event_id', 'frm_payload',
                 "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')")} AS uplink_guid
    FROM base),
  heard AS (
    SELECT uplink_guid, event_type, event_id, user_id, ts, k, 0 AS pos,
           CASE WHEN event_type = 'click' THEN 'near' ELSE 'gw-' || user_id END AS gateway_name FROM up
    UNION ALL
    SELECT uplink_guid, event_type, event_id, user_id, ts, k, 1, 'far-' || k FROM up WHERE event_type = 'click'),
  rx AS (
    SELECT *, {guid('uplink_rx', 'uplink_guid', 'pos')} AS rx_guid,
           {guid('uplink_gateways', 'gateway_name')} AS gateway_guid,
           CASE WHEN gateway_name = 'near' THEN {guid('uplink_locations', 'user_id + 0.5', 'cast(k AS integer) + 0.25',
                                                      'NULL')} END AS location_guid
    FROM heard),
  hops AS (SELECT *, {guid('uplink_hops', 'rx_guid', 'pos')} AS hop_guid FROM rx WHERE pos = 1),
  readings AS (
    SELECT uplink_guid, unnest(['temp', 'hum']) AS sensor_name, unnest([cast(user_id AS varchar), k]) AS sensor_value
    FROM up WHERE event_type = 'click'
    UNION ALL
    SELECT uplink_guid, unnest(['Altitude', 'Temperature']), unnest([k, cast(user_id AS varchar)])
    FROM up WHERE event_type = 'purchase'
    UNION ALL
    SELECT uplink_guid, 'state', 'on' FROM up WHERE event_type = 'error')
"""

_NO_TEXT = "NULL::varchar"
_TABLE_SQL = {
    "uplink_applications": "SELECT DISTINCT application_guid, event_type AS application_name FROM up",
    "uplink_warnings": f"""
        SELECT {guid('uplink_warnings', 'w')} AS warning_guid, w AS decoded_payload_warning
        FROM (SELECT DISTINCT '["low battery"]' AS w FROM up WHERE event_type = 'error')""",
    "uplink_locations": f"""
        SELECT DISTINCT location_guid, cast(user_id + 0.5 AS double) AS latitude,
               cast(cast(k AS integer) + 0.25 AS double) AS longitude, {_NO_TEXT} AS source
        FROM rx WHERE location_guid IS NOT NULL""",
    "uplink_gateways": """
        SELECT gateway_guid, arg_min_null(location_guid, ts) AS location_guid, gateway_name
        FROM rx GROUP BY gateway_guid, gateway_name""",
    "uplink_sensors": f"""
        SELECT DISTINCT {guid('uplink_sensors', 'sensor_name')} AS sensor_guid, sensor_name, {_NO_TEXT} AS sensor_type,
               {_NO_TEXT} AS sensor_location, {_NO_TEXT} AS measurement_unit FROM readings""",
    "uplink_devices": f"""
        SELECT device_guid, arg_min(application_guid, ts) AS application_guid, device_name,
               {_NO_TEXT} AS device_location, arg_min('eui-' || event_type, ts) AS dev_eui, {_NO_TEXT} AS join_eui,
               arg_min(cast(user_id AS varchar), ts) AS dev_addr
        FROM up GROUP BY device_guid, device_name""",
    "uplink_uplinks": f"""
        SELECT uplink_guid, device_guid,
               CASE WHEN event_type = 'error' THEN {guid('uplink_warnings', "'[" + '"low battery"' + "]'")} END
                 AS warning_guid,
               session_key_id, cast(k AS integer) AS f_port, cast(event_id AS integer) AS f_cnt, frm_payload,
               CASE event_type WHEN 'click' THEN cast(event_id AS varchar) WHEN 'error' THEN cast(user_id AS varchar)
               END AS raw_bytes,
               CASE WHEN event_type <> 'error' THEN cast(user_id + 0.5 AS double) END AS consumed_airtime FROM up""",
    "uplink_rx": f"""
        SELECT rx_guid, gateway_guid, uplink_guid, CASE WHEN gateway_name = 'near' THEN ts END AS rx_time,
               CASE WHEN gateway_name = 'near' OR event_type = 'purchase' THEN event_id END AS rx_timestamp,
               CASE WHEN pos = 0 THEN cast(user_id AS integer) END AS rssi, NULL::integer AS channel_rssi,
               NULL::double AS snr, {_NO_TEXT} AS message_id, CASE WHEN pos = 1 THEN 19 END AS forwarder_net_id,
               {_NO_TEXT} AS forwarder_tenant_id, {_NO_TEXT} AS forwarder_cluster_id,
               NULL::integer AS home_network_net_id, {_NO_TEXT} AS home_network_tenant_id,
               {_NO_TEXT} AS home_network_cluster_id FROM rx""",
    "uplink_hops": """
        SELECT hop_guid, rx_guid, 'a' AS sender_address, 'b' AS receiver_name, 'c' AS receiver_agent FROM hops""",
    "uplink_datetimes": f"""
        SELECT rx_guid, {_NO_TEXT} AS hop_guid, {_NO_TEXT} AS uplink_guid, ts + INTERVAL 1 SECOND AS received_at
        FROM rx WHERE pos = 0
        UNION ALL SELECT NULL, hop_guid, NULL, ts FROM hops
        UNION ALL SELECT NULL, NULL, uplink_guid, ts FROM up""",
    "uplink_correlation_ids": f"""
        SELECT {guid('uplink_correlation_ids', 'rx_guid', 'i', 'correlation_id')} AS correlation_guid, rx_guid,
               correlation_id
        FROM (SELECT rx_guid, unnest([0, 1]) AS i, unnest(['as:' || event_id, 'gs']) AS correlation_id
              FROM rx WHERE pos = 0)""",
    "uplink_tokens": "SELECT rx_guid, gateway_guid, 'token-' || event_id AS uplink_token FROM rx WHERE pos = 1",
    "uplink_readings": f"""
        SELECT uplink_guid, {guid('uplink_sensors', 'sensor_name')} AS sensor_guid, sensor_value FROM readings""",
    "uplink_settings": f"""
        SELECT {guid('uplink_settings', 'uplink_guid')} AS uplink_setting_guid, uplink_guid, 125000 AS bandwidth,
               7 AS spreading_factor, 5 AS data_rate_index, '4/5' AS coding_rate, user_id + 868100000 AS frequency,
               CASE WHEN event_type <> 'error' THEN event_id END AS setting_timestamp FROM up""",
}


def stored(frames: dict[str, DataFrame], name: str) -> DataFrame:
    spec = uplink.TABLES[name]
    rows = dimension_rows(frames[name], spec) if spec.is_dimension else frames[name].select(*spec.schema.names)
    times = [field.name for field in rows.schema if field.dataType.typeName() == "timestamp"]
    return rows.withColumns({column: F.col(column).cast("timestamp_ntz") for column in times})


def _register(name: str) -> None:
    @query(name, f"WITH {UPLINKS_SQL} {_TABLE_SQL[name]}")
    def stored_table(spark, sf_dir):
        return stored(uplink.build(documents(spark, sf_dir)), name)


for _name in _TABLE_SQL:
    _register(_name)


@query("uplink_rejects", """
SELECT event_type AS application_id, reject_reason, count(*) AS documents
FROM (SELECT event_type, CASE event_type WHEN 'view' THEN 'no receivers' ELSE 'fewer values than names' END
        AS reject_reason FROM events WHERE event_type IN ('view', 'signup'))
GROUP BY 1, 2
""")
def uplink_rejects(spark, sf_dir):
    rejected = uplink.prepare(documents(spark, sf_dir))[1]
    return rejected.groupBy(
        F.col("end_device_ids.application_ids.application_id").alias("application_id"), "reject_reason",
    ).agg(F.count("*").alias("documents"))


@query("uplink_rx_first", f"""
WITH {UPLINKS_SQL}
SELECT first.rx_guid, last.gateway_guid, first.uplink_guid, cast(first.user_id AS integer) AS rssi,
       CASE WHEN first.event_type = 'click' THEN 'token-' || first.event_id END AS uplink_token
FROM (SELECT * FROM rx WHERE pos = 0) first
JOIN (SELECT uplink_guid, arg_max(gateway_guid, pos) AS gateway_guid FROM rx GROUP BY uplink_guid) last
  ON first.uplink_guid = last.uplink_guid
""")
def uplink_rx_first(spark, sf_dir):
    """One receiver per uplink: the first one's metrics with the last one's gateway."""
    frames = uplink.build(documents(spark, sf_dir), rx_mode="first")
    rows = frames["uplink_rx"].select("rx_guid", "gateway_guid", "uplink_guid", "rssi")
    return rows.join(frames["uplink_tokens"].select("rx_guid", "uplink_token"), "rx_guid", "left")
