"""The operators as queries on the test tables, each with the same result stated in DuckDB's SQL.

Windows are one day long, since the test events are minutes apart; the width is a parameter everywhere.
"""

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewatch import schemas
from spindlewatch.functions.json_codec import decode_events, encode_events, malformed_events
from spindlewatch.functions.shared import map_with_resource
from spindlewatch.functions.text import status_line
from spindlewatch.functions.times import to_epoch_ms, utc_timestamp
from spindlewatch.operators.controls import routed, to_messages, with_action
from spindlewatch.operators.latest import latest_status
from spindlewatch.operators.lookup import unmatched_keys, with_faulty_odds, with_limits
from spindlewatch.operators.monitor import (
    accumulate,
    match_count,
    matching_machines,
    monitor_rows,
    status_of,
)
from spindlewatch.operators.numbering import nth_smallest
from spindlewatch.operators.refdata import last_per_key, round_robin, top_up
from spindlewatch.operators.windows import status_rows, tumbling_average
from spindlewatch.plans.controller import start_controller
from spindlewatch.plans.profile_load import ProfileStore
from spindlewatch.plans.shop_tables import (
    limits,
    messages,
    profiles,
    solvent_profiles,
    table,
    telemetry,
    telemetry_stream,
    template_lines,
)
from spindlewatch.plans.temperature_monitor import (
    MonitorOptions,
    TemperatureMonitor,
    label_averages,
    monitored_changes,
    start_label_query,
    start_status_query,
)
from spindlewatch.session import run_dir, session_conf, stream_conf
from spindlewatch.sources.tables import (
    key_set,
    make_folder,
    point_lookup,
    read_profiles,
    read_table,
    register_tables,
    write_profiles,
)
from spindlewatch.sources.templates import accepted_templates, read_lines, rejected_lines
from spindlewatch.sources.topics import file_messages
from spindlewatch.streaming.feeds import Harvest, Subscription
from spindlewatch.streaming.keyed_table import KeyedTable
from spindlewatch.streaming.label_state import state_conf, stateful_label_changes
from spindlewatch.streaming.late_rows import count_late_rows
from spindlewatch.streaming.sinks import log_lines, logged, message_batch_sink, tee, write_messages

DAILY = MonitorOptions(width="1 day", trigger=(("availableNow", True),))
PLACE, BLOCK = "NATION_11", "MACHINERY"
OTHER_PLACE, OTHER_BLOCK = "NATION_5", "BUILDING"

QUERIES = {}
ORACLES = {}


def query(sql=None):
    """Register a function (session, folder of the tables) under its own name, with its oracle."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


# ---- the test tables in SQL -------------------------------------------------------------------------

_TELEMETRY = "telemetry AS (SELECT user_id AS serialNum, ts, CAST(floor(value) AS SMALLINT) AS bitTemp FROM events)"


def _averages(width="1 day", name="averages"):
    return (
        f"{name} AS (SELECT serialNum, epoch_ms(time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}') AS windowEnd, "
        "avg(bitTemp) AS avgTemp FROM telemetry GROUP BY ALL)"
    )


_AVERAGES = f"{_TELEMETRY}, {_averages()}"

# A stream has emitted the windows that ended no later than its newest event less the allowed lag.
_CLOSED = (
    f"{_TELEMETRY}, {_averages(name='every_average')}, averages AS (SELECT * FROM every_average "
    "WHERE windowEnd <= (SELECT epoch_us(max(ts)) // 1000 - 2000 FROM events))"
)

_STATUS = (
    "status AS (SELECT serialNum AS serialNumber, CAST(trunc(avgTemp) AS SMALLINT) AS averageBitTemp10s, "
    "windowEnd AS eventTime FROM averages)"
)

_PROFILE_COLUMNS = (
    "c_custkey AS serialNum, n_name AS location, c_mktsegment AS block, "
    "CAST(c_custkey % 8 * 0.125 AS FLOAT) AS faultyOdds, c_name AS manufacturer, "
    "CAST(20 + 20 * (c_custkey % 4) AS SMALLINT) AS warningTemp, "
    "CAST(80 + 20 * (c_custkey % 4) AS SMALLINT) AS criticalTemp, "
    "CAST(8000 + 1000 * (c_custkey % 5) AS INTEGER) AS maxRPM"
)
_PROFILES = f"profiles AS (SELECT {_PROFILE_COLUMNS} FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_SOLVENT = (
    f"solvent AS (SELECT {_PROFILE_COLUMNS} FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "WHERE c_acctbal >= 0)"
)

_LABELLED = (
    "labelled AS (SELECT a.*, warningTemp, criticalTemp, CASE WHEN avgTemp > criticalTemp THEN 'red' "
    "WHEN avgTemp > warningTemp THEN 'orange' ELSE 'green' END AS label "
    "FROM averages a JOIN profiles USING (serialNum))"
)
_CHANGES = (
    "changes AS (SELECT serialNum, windowEnd, avgTemp, label FROM (SELECT *, lag(label, 1, '') OVER "
    "(PARTITION BY serialNum ORDER BY windowEnd) AS previous FROM labelled) WHERE label <> previous)"
)
_MONITOR = f"{_AVERAGES}, {_PROFILES}, {_LABELLED}, {_CHANGES}"
_CLOSED_MONITOR = f"{_CLOSED}, {_PROFILES}, {_LABELLED}, {_CHANGES}"


def _selection(place, block):
    return f"SELECT serialNum FROM profiles WHERE location = '{place}' AND block = '{block}'"


def _sql_lines(table_name, key, place, block):
    good = f"{place} || ',' || {block} || ',.' || ({key} % 10)"
    return (
        f"lines AS (SELECT {key} AS line, CASE {key} % 9 WHEN 0 THEN {place} || ',' || {block} "
        f"WHEN 1 THEN {good} || ',x' WHEN 2 THEN {place} || ',' || {block} || ',abc' WHEN 3 THEN '' "
        f"WHEN 4 THEN {good} || ',,' WHEN 5 THEN {place} || ',' || {block} || ', .' || ({key} % 10) "
        f"WHEN 6 THEN {place} || ',' || {block} || ',' ELSE {good} END AS value FROM {table_name}), "
        "fields AS (SELECT *, string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM lines WHERE value <> ''), "
        "checked AS (SELECT *, TRY_CAST(trim(f[3]) AS FLOAT) AS fraction FROM fields), "
        "accepted AS (SELECT line, f[1] AS location, f[2] AS block, CAST(fraction AS DOUBLE) AS faultyFraction "
        "FROM checked WHERE len(f) = 3 AND fraction IS NOT NULL)"
    )


_CUSTOMER_LINES = _sql_lines("customer", "c_custkey", "c_name", "c_mktsegment")
_SUPPLIER_LINES = _sql_lines("supplier", "s_suppkey", "'N' || s_nationkey", "s_name")
_TEMPLATES = (
    f"{_SUPPLIER_LINES}, templates AS (SELECT location, block, faultyFraction, "
    "row_number() OVER (ORDER BY line) - 1 AS turn FROM accepted)"
)

# The text of a telemetry message; its parts are the same as in shop_tables.messages.
_EVENT_TEXT = (
    "'{\"serialNum\":\"' || user_id || '\",\"eventTime\":' || (epoch_us(ts) // 1000) || ',\"bitRPM\":10000,\"bitTemp\":' || "
    "CAST(floor(value) AS INTEGER)"
)
_EVENT_TEXT_END = "',\"bitPositionX\":0,\"bitPositionY\":0,\"bitPositionZ\":0}'"


# ---- profiles ---------------------------------------------------------------------------------------


@query(f"WITH {_PROFILES} SELECT * FROM profiles")
def scan_profiles(spark, sf_dir):
    return profiles(spark, sf_dir)


@query(f"WITH {_PROFILES} SELECT * FROM profiles WHERE serialNum = 42")
def profile_lookup(spark, sf_dir):
    return point_lookup(profiles(spark, sf_dir), "serialNum", 42)


@query("SELECT count(*) AS machines FROM customer")
def profile_keys_count(spark, sf_dir):
    return key_set(limits(spark, sf_dir)).agg(F.count(F.lit(1)).alias("machines"))


@query(f"WITH {_PROFILES} {_selection(PLACE, BLOCK)}")
def location_block_keys(spark, sf_dir):
    return matching_machines(profiles(spark, sf_dir), PLACE, BLOCK)


@query(f"WITH {_PROFILES} SELECT count(*) AS matches FROM ({_selection(PLACE, BLOCK)})")
def location_block_count(spark, sf_dir):
    return match_count(profiles(spark, sf_dir), PLACE, BLOCK)


@query(
    f"WITH {_PROFILES}, placed AS (SELECT * REPLACE (CASE WHEN location = '{OTHER_PLACE}' THEN '' ELSE location END AS location) "
    f"FROM profiles) SELECT * FROM placed WHERE location IN ('{PLACE}', '') AND block = '{BLOCK}'"
)
def stored_location_selection(spark, sf_dir):
    """A selection on profiles stored by location, one of them without a name: only those folders are read."""
    path = run_dir(spark, "profiles")
    place = F.when(F.col("location") == OTHER_PLACE, "").otherwise(F.col("location"))
    placed = profiles(spark, sf_dir).withColumns({"location": place, "serialNum": F.col("serialNum").cast("string")})
    write_profiles(placed, path)
    stored = read_profiles(spark, path)
    chosen = stored.where(F.col("location").isin(PLACE, "") & (F.col("block") == BLOCK))
    return chosen.withColumn("serialNum", F.col("serialNum").cast("bigint"))


@query(f"WITH {_PROFILES} SELECT * FROM profiles WHERE serialNum IN (42, 777)")
def stored_profile_lookup(spark, sf_dir):
    """Look-ups of two serial numbers in stored profiles, by the Bloom filters of their row groups."""
    path = run_dir(spark, "profiles")
    write_profiles(profiles(spark, sf_dir).withColumn("serialNum", F.col("serialNum").cast("string")), path)
    stored = read_profiles(spark, path)
    found = point_lookup(stored, "serialNum", "42").unionByName(point_lookup(stored, "serialNum", "777"))
    return found.withColumn("serialNum", F.col("serialNum").cast("bigint"))


@query(
    f"WITH {_AVERAGES}, {_STATUS}, {_PROFILES} SELECT serialNumber, averageBitTemp10s, eventTime FROM status JOIN profiles "
    f"ON serialNumber = serialNum WHERE location = '{PLACE}'"
)
def sql_names(spark, sf_dir):
    """The tables under their SQL names."""
    register_tables(spark, profiles=profiles(spark, sf_dir), status=status_table_rows(spark, sf_dir))
    return spark.sql(
        "SELECT serialNumber, averageBitTemp10s, eventTime FROM machine_status JOIN machine_profiles "
        "ON serialNumber = serialNum WHERE location = :place",
        args={"place": PLACE},
    )


# ---- messages ---------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def parse_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int").k.alias("k"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def parse_with_shared_decoder(spark, sf_dir):
    """The same with a Python decoder that every task opens once; for what has no built-in function."""

    def decode(decoder, frame):
        return frame.assign(k=[decoder.decode(text)["k"] for text in frame.pop("props")])

    props = table(spark, sf_dir, "events").select("event_id", "props")
    return map_with_resource(props, json.JSONDecoder, decode, "event_id bigint, k int")


@query(
    "SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(ts) // 1000 AS recordTime, CAST(user_id AS VARCHAR) AS serialNum, "
    "epoch_us(ts) // 1000 AS eventTime, 10000 AS bitRPM, CAST(floor(value) AS SMALLINT) AS bitTemp, 0 AS bitPositionX, "
    "0 AS bitPositionY, 0 AS bitPositionZ FROM events WHERE event_type <> 'error'"
)
def decode_messages(spark, sf_dir):
    events = decode_events(messages(spark, sf_dir), on_malformed="quarantine")
    return events.select("key", to_epoch_ms(F.col("timestamp")).alias("recordTime"), *schemas.MACHINE_EVENT.names)


@query(
    f"SELECT CAST(user_id AS VARCHAR) AS key, {_EVENT_TEXT} AS value, epoch_us(ts) // 1000 AS recordTime FROM events "
    "WHERE event_type = 'error'"
)
def malformed_messages(spark, sf_dir):
    bad = malformed_events(messages(spark, sf_dir))
    return bad.select("key", "value", to_epoch_ms(F.col("timestamp")).alias("recordTime"))


@query(f"SELECT CAST(user_id AS VARCHAR) AS key, {_EVENT_TEXT} || {_EVENT_TEXT_END} AS value, epoch_us(ts) // 1000 AS recordTime FROM events")
def encode_messages(spark, sf_dir):
    events = telemetry(spark, sf_dir).withColumns(
        {
            "eventTime": to_epoch_ms(utc_timestamp(F.col("timestamp"))),
            "bitRPM": F.lit(10000),
            "bitPositionX": F.lit(0),
            "bitPositionY": F.lit(0),
            "bitPositionZ": F.lit(0),
        }
    )
    return encode_events(events).select("key", "value", to_epoch_ms(F.col("timestamp")).alias("recordTime"))


# ---- averages and status ----------------------------------------------------------------------------


@query(f"WITH {_AVERAGES} SELECT * FROM averages")
def tumbling_avg(spark, sf_dir):
    return tumbling_average(telemetry(spark, sf_dir), DAILY.width)


@query(f"WITH {_TELEMETRY}, {_averages('10 seconds')} SELECT * FROM averages")
def tumbling_avg_10s(spark, sf_dir):
    return tumbling_average(telemetry(spark, sf_dir))


@query(f"WITH {_AVERAGES}, {_STATUS} SELECT * FROM status")
def status_table_rows(spark, sf_dir):
    return status_rows(tumbling_avg(spark, sf_dir))


@query(f"WITH {_AVERAGES}, {_STATUS} SELECT * FROM status QUALIFY row_number() OVER (PARTITION BY serialNumber ORDER BY eventTime DESC) = 1")
def latest_status_rows(spark, sf_dir):
    return latest_status(status_table_rows(spark, sf_dir))


# ---- look-ups and labels ----------------------------------------------------------------------------


@query(f"WITH {_AVERAGES}, {_PROFILES} SELECT averages.*, warningTemp, criticalTemp FROM averages JOIN profiles USING (serialNum)")
def lookup_limits(spark, sf_dir):
    return with_limits(tumbling_avg(spark, sf_dir), limits(spark, sf_dir))


@query(f"WITH {_AVERAGES}, {_SOLVENT} SELECT averages.*, warningTemp, criticalTemp FROM averages JOIN solvent USING (serialNum)")
def lookup_limits_drop(spark, sf_dir):
    return with_limits(tumbling_avg(spark, sf_dir), solvent_profiles(spark, sf_dir), "drop")


@query(f"WITH {_AVERAGES}, {_PROFILES}, {_LABELLED} SELECT * FROM labelled")
def threshold_labels(spark, sf_dir):
    return label_averages(tumbling_avg(spark, sf_dir), limits(spark, sf_dir))


@query(
    f"WITH {_AVERAGES}, {_SOLVENT} SELECT serialNum, windowEnd, CASE WHEN warningTemp IS NULL THEN 'unknown' "
    "WHEN avgTemp > criticalTemp THEN 'red' WHEN avgTemp > warningTemp THEN 'orange' ELSE 'green' END AS label "
    "FROM averages LEFT JOIN solvent USING (serialNum)"
)
def threshold_labels_unknown(spark, sf_dir):
    labelled = label_averages(tumbling_avg(spark, sf_dir), solvent_profiles(spark, sf_dir), "unknown")
    return labelled.select("serialNum", "windowEnd", "label")


@query(f"WITH {_AVERAGES}, {_SOLVENT} SELECT serialNum, count(*) AS rows FROM averages ANTI JOIN solvent USING (serialNum) GROUP BY serialNum")
def missing_profiles(spark, sf_dir):
    return unmatched_keys(tumbling_avg(spark, sf_dir), solvent_profiles(spark, sf_dir))


@query(
    f"WITH {_AVERAGES}, {_SOLVENT} SELECT averages.*, CAST(coalesce(faultyOdds, CAST(0.1 AS FLOAT)) AS DOUBLE) AS "
    "faultyOdds FROM averages LEFT JOIN solvent USING (serialNum)"
)
def default_odds(spark, sf_dir):
    odds = with_faulty_odds(tumbling_avg(spark, sf_dir), solvent_profiles(spark, sf_dir))
    return odds.withColumn("faultyOdds", F.col("faultyOdds").cast("double"))


# ---- changes and controls ---------------------------------------------------------------------------


@query(f"WITH {_MONITOR} SELECT * FROM changes")
def label_changes(spark, sf_dir):
    return monitored_changes(telemetry(spark, sf_dir), limits(spark, sf_dir), DAILY)


# Temperatures that are missing, and the label of an average that is missing for it.
_SPARSE = (
    "telemetry AS (SELECT user_id AS serialNum, ts, CASE WHEN event_type = 'click' THEN CAST(floor(value) AS SMALLINT) END "
    f"AS bitTemp FROM events), {_averages()}, {_PROFILES}, {_LABELLED.replace('CASE WHEN', 'CASE WHEN avgTemp IS NULL THEN NULL WHEN')}"
)


@query(
    f"WITH {_SPARSE}, known AS (SELECT * FROM labelled WHERE label IS NOT NULL), "
    f"{_CHANGES.replace('FROM labelled', 'FROM known')} SELECT * FROM changes"
)
def label_changes_missing(spark, sf_dir):
    """Changes where some windows have no temperature at all: those are passed over."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("serialNum"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "click", F.floor("value").cast("smallint")).alias("bitTemp"),
    )
    return monitored_changes(events, limits(spark, sf_dir), DAILY)


@query(
    f"WITH {_MONITOR} SELECT CAST(serialNum AS VARCHAR) AS key, windowEnd, label AS value, CASE label WHEN 'red' THEN "
    "'reduce speed' ELSE 'resume normal speed' END AS action, serialNum || CASE label WHEN 'red' THEN "
    "' went RED, reducing speed' ELSE ' went GREEN, resuming normal speed' END AS line FROM changes WHERE label <> 'orange'"
)
def control_messages(spark, sf_dir):
    published = to_messages(label_changes(spark, sf_dir), timestamp="windowEnd")
    return with_action(published).withColumnRenamed("timestamp", "windowEnd")


@query(
    f"WITH {_MONITOR}, {_SOLVENT}, running AS (SELECT DISTINCT user_id AS serialNum FROM events WHERE event_type = 'view') "
    "SELECT serialNum, label AS value, CASE label WHEN 'red' THEN 'reduce speed' ELSE 'resume normal speed' END AS action, "
    "serialNum || CASE label WHEN 'red' THEN ' went RED, reducing speed' ELSE ' went GREEN, resuming normal speed' END AS line, "
    "CAST(coalesce(s.faultyOdds, CAST(0.1 AS FLOAT)) AS DOUBLE) AS faultyOdds "
    "FROM changes SEMI JOIN running USING (serialNum) LEFT JOIN solvent s USING (serialNum) WHERE label <> 'orange'"
)
def control_routing(spark, sf_dir):
    controls = label_changes(spark, sf_dir).select(F.col("serialNum").alias("key"), F.col("label").alias("value"))
    running = table(spark, sf_dir, "events").where("event_type = 'view'").select(F.col("user_id").alias("serialNum"))
    out = routed(controls, running.distinct(), solvent_profiles(spark, sf_dir))
    return out.withColumn("faultyOdds", F.col("faultyOdds").cast("double"))


# ---- following a selection --------------------------------------------------------------------------


def _monitored(spark, sf_dir, place, block):
    machines = matching_machines(profiles(spark, sf_dir), place, block)
    rows = monitor_rows(status_of(status_table_rows(spark, sf_dir), machines))
    return rows.withColumn("event_time", to_epoch_ms(F.col("event_time")))


_MONITOR_COLUMNS = (
    "SELECT CAST(serialNumber AS VARCHAR) AS serial_number, CAST(averageBitTemp10s AS INTEGER) AS "
    "average_bit_temp_10s, eventTime AS event_time FROM status WHERE serialNumber IN"
)


@query(f"WITH {_AVERAGES}, {_STATUS}, {_PROFILES} {_MONITOR_COLUMNS} ({_selection(PLACE, BLOCK)})")
def monitor_status(spark, sf_dir):
    return _monitored(spark, sf_dir, PLACE, BLOCK)


@query(
    f"WITH {_AVERAGES}, {_STATUS}, {_PROFILES} {_MONITOR_COLUMNS} ({_selection(PLACE, BLOCK)}) "
    f"UNION ALL {_MONITOR_COLUMNS} ({_selection(OTHER_PLACE, OTHER_BLOCK)})"
)
def monitor_union(spark, sf_dir):
    first = _monitored(spark, sf_dir, PLACE, BLOCK)
    return accumulate(first, _monitored(spark, sf_dir, OTHER_PLACE, OTHER_BLOCK))


@query(f"WITH {_AVERAGES}, {_STATUS}, {_PROFILES} {_MONITOR_COLUMNS} ({_selection(PLACE, BLOCK)})")
def monitor_blank(spark, sf_dir):
    """A blank location or block selects nothing and adds nothing."""
    seen = _monitored(spark, sf_dir, PLACE, BLOCK)
    for place, block in (("", BLOCK), (PLACE, None)):
        seen = accumulate(seen, _monitored(spark, sf_dir, place, block))
    return seen


# ---- reference data ---------------------------------------------------------------------------------


def _customer_lines(spark, sf_dir):
    return template_lines(table(spark, sf_dir, "customer"), "c_custkey", F.col("c_name"), F.col("c_mktsegment"))


def _templates(spark, sf_dir):
    place = F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))
    lines = template_lines(table(spark, sf_dir, "supplier"), "s_suppkey", place, F.col("s_name"))
    return accepted_templates(lines).withColumn("faultyFraction", F.col("faultyFraction").cast("double"))


@query(f"WITH {_CUSTOMER_LINES} SELECT * FROM accepted")
def template_accepted(spark, sf_dir):
    accepted = accepted_templates(_customer_lines(spark, sf_dir))
    return accepted.withColumn("faultyFraction", F.col("faultyFraction").cast("double"))


@query(
    f"WITH {_CUSTOMER_LINES} SELECT line, value, CASE WHEN len(f) <> 3 THEN 'field count' ELSE 'number' END AS reason "
    "FROM checked WHERE len(f) <> 3 OR fraction IS NULL"
)
def template_rejected(spark, sf_dir):
    return rejected_lines(_customer_lines(spark, sf_dir))


@query(
    f"WITH {_CUSTOMER_LINES}, numbered AS (SELECT line AS key, row_number() OVER (ORDER BY line) - 1 AS line FROM lines) "
    "SELECT numbered.line, location, block, faultyFraction FROM accepted JOIN numbered ON accepted.line = key"
)
def template_files(spark, sf_dir):
    """Templates from several files, whose lines are numbered through in the order of the files."""
    folder = run_dir(spark, "templates")
    lines = _customer_lines(spark, sf_dir).repartitionByRange(3, "line").sortWithinPartitions("line")
    lines.select("value").write.text(folder)
    accepted = accepted_templates(read_lines(spark, folder))
    return accepted.withColumn("faultyFraction", F.col("faultyFraction").cast("double"))


@query(
    f"WITH {_TEMPLATES} SELECT c_custkey AS seq, c_name AS serialNum, location, block, faultyFraction FROM customer "
    "JOIN templates ON turn = c_custkey % (SELECT count(*) FROM templates)"
)
def round_robin_templates(spark, sf_dir):
    candidates = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("serialNum"))
    return round_robin(candidates, _templates(spark, sf_dir))


@query(
    f"WITH {_TEMPLATES}, chosen AS (SELECT * FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey) <= "
    "(SELECT count(*) // 2 FROM orders)), placed AS (SELECT o_orderkey AS seq, o_custkey AS serialNum, location, block, "
    "faultyFraction FROM chosen JOIN templates ON turn = o_orderkey % (SELECT count(*) FROM templates)) "
    "SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY serialNum ORDER BY seq DESC) = 1"
)
def refdata_topup(spark, sf_dir):
    """Top up the fleet by half the candidates, place them, and keep the last row per serial number."""
    orders = table(spark, sf_dir, "orders")
    candidates = orders.select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("serialNum"))
    existing = table(spark, sf_dir, "customer").where("c_acctbal < 0").count()
    chosen = top_up(candidates, existing, existing + orders.count() // 2)
    return last_per_key(round_robin(chosen, _templates(spark, sf_dir)))


_LOAD = (
    f"debt AS (SELECT {_PROFILE_COLUMNS} FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0), "
    "size AS (SELECT count(*) AS o FROM orders), "
    "chosen AS (SELECT * FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey) <= "
    "(SELECT o // 2 FROM size)), "
    "placed AS (SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS serialNum, location, block, "
    "CAST(faultyFraction AS FLOAT) AS faultyOdds, o_orderpriority AS manufacturer, "
    "CAST(20 + 20 * (o_orderkey % 4) AS SMALLINT) AS warningTemp, CAST(80 + 20 * (o_orderkey % 4) AS SMALLINT) AS criticalTemp, "
    "CAST(8000 AS INTEGER) AS maxRPM FROM chosen JOIN templates ON turn = o_orderkey % (SELECT count(*) FROM templates)), "
    "loaded AS (SELECT * EXCLUDE (seq) FROM placed QUALIFY row_number() OVER (PARTITION BY serialNum ORDER BY seq DESC) = 1), "
    "kept AS (SELECT CAST(serialNum AS VARCHAR) AS serialNum, * EXCLUDE (serialNum) FROM debt)"
)


_LOADED = (
    f"WITH {_TEMPLATES}, {_LOAD} SELECT * FROM loaded UNION ALL BY NAME SELECT * FROM kept ANTI JOIN loaded USING (serialNum)"
)


def _load(spark, sf_dir, times):
    store = ProfileStore(spark, run_dir(spark, "store"))
    in_debt = profiles(spark, sf_dir, table(spark, sf_dir, "customer").where("c_acctbal < 0"))
    store.replace(in_debt.withColumn("serialNum", F.col("serialNum").cast("string")))
    orders = table(spark, sf_dir, "orders")
    candidates = orders.select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").cast("string").alias("serialNum"),
        F.col("o_orderpriority").alias("manufacturer"),
        (F.lit(20) + F.lit(20) * (F.col("o_orderkey") % 4)).cast("smallint").alias("warningTemp"),
        F.lit(8000).alias("maxRPM"),
    )
    target = in_debt.count() + orders.count() // 2
    for i in range(times):
        store.load_once(candidates, _templates(spark, sf_dir), target + i)
    return store.read()


@query(_LOADED)
def load_profiles(spark, sf_dir):
    """The whole load into a store that has some profiles already: the store's content afterwards."""
    return _load(spark, sf_dir, 1)


@query(_LOADED)
def load_profiles_again(spark, sf_dir):
    """A second load, of more machines, finds the first one finished and does nothing."""
    return _load(spark, sf_dir, 2)


@query(
    f"WITH {_AVERAGES}, {_STATUS} SELECT 'MachineStatus{{serialNumber=''' || serialNumber || ''', averageBitTemp10s=' || "
    "averageBitTemp10s || ', eventTime=' || eventTime || '}' AS value FROM status"
)
def log_status_lines(spark, sf_dir):
    folder = make_folder(spark, run_dir(spark, "log"))
    text = status_table_rows(spark, sf_dir).withColumn("serialNumber", F.col("serialNumber").cast("string"))
    log_lines(text, "status", folder, status_line())
    return spark.read.text(f"{folder}/status")


@query(f"WITH {_AVERAGES}, {_STATUS} SELECT serialNumber, averageBitTemp10s, eventTime FROM status")
def logged_status(spark, sf_dir):
    """Status rows that are logged on their way and come out as they went in."""
    folder = make_folder(spark, run_dir(spark, "log"))
    text = status_table_rows(spark, sf_dir).withColumn("serialNumber", F.col("serialNumber").cast("string"))
    passed = logged(text, "status", folder, status_line())
    return passed.withColumn("serialNumber", F.col("serialNumber").cast("bigint"))


# ---- streams: run over the whole table, and stopped when all of it has been read ------------------------


@query(f"WITH {_CLOSED} SELECT * FROM averages")
def stream_tumbling_avg(spark, sf_dir, root=None):
    root = root or run_dir(spark, "averages")
    averages = tumbling_average(telemetry_stream(spark, sf_dir), DAILY.width, DAILY.lag)
    with session_conf(spark, stream_conf(spark)):
        query = write_messages(
            averages, f"{root}/checkpoint", "averages", dict(DAILY.trigger), "parquet", path=f"{root}/rows"
        )
    query.awaitTermination()
    return read_table(spark, f"{root}/rows", averages.schema)


@query(
    f"WITH {_CLOSED}, {_STATUS} SELECT 'MachineStatus{{serialNumber=''' || serialNumber || ''', averageBitTemp10s=' || "
    "averageBitTemp10s || ', eventTime=' || eventTime || '}' AS value FROM status"
)
def stream_logged_status(spark, sf_dir):
    """Status rows on their way into the status table, as the tee before it has logged them."""
    root = make_folder(spark, run_dir(spark, "tee"))
    status = status_rows(tumbling_average(telemetry_stream(spark, sf_dir), DAILY.width, DAILY.lag))
    text = status.withColumn("serialNumber", F.col("serialNumber").cast("string"))
    into = KeyedTable(spark, f"{root}/table", schemas.MACHINE_STATUS, "serialNumber", "eventTime")
    with session_conf(spark, DAILY.stream_conf(spark)):
        query = (
            text.writeStream.option("checkpointLocation", f"{root}/checkpoint")
            .trigger(**dict(DAILY.trigger))
            .foreachBatch(tee("status", root, status_line(), into.put))
            .start()
        )
    query.awaitTermination()
    return spark.read.text(f"{root}/status/batch=*")


@query(f"WITH {_CLOSED_MONITOR} SELECT serialNum, windowEnd, label FROM changes")
def stream_label_changes(spark, sf_dir):
    """The label branch as a query of its own."""
    root = run_dir(spark, "labels")
    events = telemetry_stream(spark, sf_dir)
    query, changes = start_label_query(spark, events, limits(spark, sf_dir), root, DAILY, key_type="bigint")
    query.awaitTermination()
    return changes.history()


@query(f"WITH {_CLOSED_MONITOR} SELECT serialNum, windowEnd, label FROM changes")
def stream_label_state(spark, sf_dir):
    """The same by Spark's keyed state, on the stream of averages that another query has written."""
    root = run_dir(spark, "state")
    averages = stream_tumbling_avg(spark, sf_dir, f"{root}/averages")
    written = spark.readStream.schema(averages.schema).parquet(f"{root}/averages/rows")
    changes = stateful_label_changes(label_averages(written, limits(spark, sf_dir)))
    with session_conf(spark, state_conf(spark)):
        query = write_messages(changes, f"{root}/checkpoint", "state", dict(DAILY.trigger), "parquet", path=f"{root}/rows")
    query.awaitTermination()
    return read_table(spark, f"{root}/rows", changes.schema)


# What is left out as late when the events before the last two days come after those: one row per machine and day.
_LATE = (
    "latest AS (SELECT date_trunc('day', max(ts)) - INTERVAL 1 DAY AS since FROM events) "
    "SELECT count(*) AS late FROM (SELECT DISTINCT user_id, date_trunc('day', ts) FROM events, latest WHERE ts < since)"
)


@query(f"WITH {_LATE}")
def stream_late_rows(spark, sf_dir):
    """Averages of the newest events first; those of every earlier day come too late, one row per machine and day."""
    root = run_dir(spark, "late")
    events = telemetry(spark, sf_dir)
    since = events.agg((F.date_trunc("day", F.max("timestamp")) - F.expr("interval 1 day")).cast("timestamp_ntz").alias("t")).first().t
    newest = events.where(F.col("timestamp") >= F.lit(since))
    day = F.date_trunc("day", "timestamp").cast("timestamp_ntz")
    earlier = events.where(F.col("timestamp") < F.lit(since)).groupBy("serialNum", day.alias("timestamp"))
    counter = count_late_rows(spark, "late", f"{root}/late")
    try:
        # The second part is put when the first has closed its windows; the query is started again for it.
        for part in (newest, earlier.agg(F.max("bitTemp").alias("bitTemp"))):
            part.select("serialNum", "timestamp", "bitTemp").write.mode("append").parquet(f"{root}/events")
            stream = spark.readStream.schema(events.select("serialNum", "timestamp", "bitTemp").schema).parquet(f"{root}/events")
            with session_conf(spark, stream_conf(spark)):
                averages = tumbling_average(stream, DAILY.width, DAILY.lag)
                query = write_messages(averages, f"{root}/checkpoint", "late", dict(DAILY.trigger), "parquet", path=f"{root}/rows")
            query.awaitTermination()
            counter.await_batch(query.lastProgress["batchId"])
        return spark.range(1).select(F.lit(counter.total()).cast("bigint").alias("late"))
    finally:
        spark.streams.removeListener(counter)


@query(f"WITH {_CLOSED}, {_STATUS} SELECT * FROM status QUALIFY row_number() OVER (PARTITION BY serialNumber ORDER BY eventTime DESC) = 1")
def stream_latest_status(spark, sf_dir):
    root = run_dir(spark, "status")
    query, averages = start_status_query(spark, telemetry_stream(spark, sf_dir), root, DAILY, key_type="bigint")
    query.awaitTermination()
    return status_rows(averages.latest())


def _monitor(spark, sf_dir):
    root = run_dir(spark, "monitor")
    publish = message_batch_sink("parquet", path=f"{root}/controls")
    return TemperatureMonitor(spark, root, lambda: limits(spark, sf_dir), publish, DAILY, key_type="bigint")


def _run_monitor(spark, sf_dir):
    monitor = _monitor(spark, sf_dir)
    monitor.start(telemetry_stream(spark, sf_dir)).awaitTermination()
    return monitor


@query(f"WITH {_CLOSED_MONITOR} SELECT CAST(serialNum AS VARCHAR) AS key, label AS value FROM changes")
def stream_control_messages(spark, sf_dir):
    """The whole monitor as one query: what it has published."""
    monitor = _run_monitor(spark, sf_dir)
    return read_table(spark, f"{monitor.root}/controls", schemas.CONTROL_MESSAGE)


_ACTED = (
    "acted AS (SELECT serialNum, label AS value, CASE label WHEN 'red' THEN 'reduce speed' ELSE 'resume normal speed' END "
    "AS action, serialNum || CASE label WHEN 'red' THEN ' went RED, reducing speed' ELSE ' went GREEN, resuming normal "
    "speed' END AS line FROM changes WHERE label <> 'orange')"
)


@query(
    f"WITH {_CLOSED_MONITOR}, {_SOLVENT}, {_ACTED} SELECT CAST(serialNum AS VARCHAR) AS serialNum, value, action, line, "
    "CAST(coalesce(faultyOdds, CAST(0.1 AS FLOAT)) AS DOUBLE) AS faultyOdds FROM acted LEFT JOIN solvent USING (serialNum)"
)
def stream_control_actions(spark, sf_dir):
    """The controller on the messages of the monitor: what it does to every machine."""
    monitor = _run_monitor(spark, sf_dir)
    root = run_dir(spark, "controller")
    text_key = F.col("serialNum").cast("string")
    machines = limits(spark, sf_dir).select(text_key.alias("serialNum"))
    known = solvent_profiles(spark, sf_dir).withColumn("serialNum", text_key)
    controls = file_messages(spark, f"{monitor.root}/controls/batch=*", schema=schemas.CONTROL_MESSAGE)
    controller = start_controller(
        controls,
        lambda: machines,
        lambda: known,
        message_batch_sink("parquet", path=f"{root}/actions"),
        message_batch_sink("parquet", path=f"{root}/unmatched"),
        f"{root}/checkpoint",
        dict(DAILY.trigger),
    )
    controller.awaitTermination()
    actions = spark.read.parquet(f"{root}/actions").drop("batch")
    return actions.withColumn("faultyOdds", F.col("faultyOdds").cast("double"))


@query(f"WITH {_CLOSED}, {_STATUS}, {_PROFILES} {_MONITOR_COLUMNS} ({_selection(PLACE, BLOCK)})")
def stream_monitor(spark, sf_dir):
    """Two selections, one after the other, on the status table of a monitor: the first is made before the
    monitor has put anything and sees all of it, the second afterwards and sees nothing."""
    monitor = _monitor(spark, sf_dir)
    subscription = Subscription(
        spark, monitor.averages, lambda: profiles(spark, sf_dir), {"processingTime": "1 second"}, status_rows
    )
    first = subscription.select(PLACE, BLOCK)
    monitor.start(telemetry_stream(spark, sf_dir)).awaitTermination()
    seen = _harvested(subscription, first)
    then = subscription.select(OTHER_PLACE, OTHER_BLOCK)
    seen = accumulate(seen, _harvested(subscription, then))
    subscription.stop()
    return seen


def _harvested(subscription, machines):
    if machines:
        subscription.query.processAllAvailable()
    return subscription.results().withColumn("event_time", to_epoch_ms(F.col("event_time")))


@query(f"WITH {_CLOSED}, {_STATUS}, {_PROFILES} {_MONITOR_COLUMNS} ({_selection(OTHER_PLACE, OTHER_BLOCK)})")
def stream_monitor_earliest(spark, sf_dir):
    """A selection made after all rows were put, from the earliest one on."""
    monitor = _run_monitor(spark, sf_dir)
    subscription = Subscription(
        spark, monitor.averages, lambda: profiles(spark, sf_dir), dict(DAILY.trigger), status_rows, "earliest"
    )
    if subscription.select(OTHER_PLACE, OTHER_BLOCK):
        subscription.query.awaitTermination()
    return subscription.results().withColumn("event_time", to_epoch_ms(F.col("event_time")))


@query(f"WITH {_CLOSED}, {_STATUS} SELECT * FROM status WHERE serialNumber = 8")
def stream_key_feed(spark, sf_dir):
    """Every put of one machine's status."""
    monitor = _run_monitor(spark, sf_dir)
    root = run_dir(spark, "feed")
    rows = Harvest(spark, f"{root}/rows", schemas.machine_status("bigint"))
    monitor.follow_status(rows.put, f"{root}/feed", dict(DAILY.trigger), key=8).awaitTermination()
    return rows.all()


# Three harvests of a feed, and which windows each of them has.
_HARVESTS = (
    "SELECT serialNumber, averageBitTemp10s, eventTime, CASE WHEN rank <= total // 3 THEN 1 WHEN rank <= total // 3 * 2 THEN 2 "
    "ELSE 3 END AS harvest FROM (SELECT *, dense_rank() OVER (ORDER BY eventTime) AS rank FROM status), "
    "(SELECT count(DISTINCT eventTime) AS total FROM status)"
)


@query(f"WITH {_AVERAGES}, {_STATUS} {_HARVESTS}")
def stream_harvest(spark, sf_dir):
    """Status rows put in three parts by time, each harvested when it is there: no row comes twice or not at all.
    The subscription is stopped after the first part, and another one goes on with its folder."""
    status = status_table_rows(spark, sf_dir).withColumn("serialNumber", F.col("serialNumber").cast("string"))
    root = run_dir(spark, "harvest")
    status.write.parquet(f"{root}/status")
    status = spark.read.parquet(f"{root}/status")
    ends = status.select("eventTime").distinct()
    count = ends.count()
    # The last windows of the first and the second third.
    first, second = (nth_smallest(ends, "eventTime", n) if n else -1 for n in (count // 3, count // 3 * 2))
    machines = status.select(F.col("serialNumber").alias("serialNum"), F.lit("all").alias("location"), F.lit("all").alias("block")).distinct()
    into = KeyedTable(spark, f"{root}/table", schemas.MACHINE_STATUS, "serialNumber", "eventTime", compact_every=2)
    every = {"processingTime": "200 milliseconds"}
    subscription = Subscription(spark, into, lambda: machines, every)
    subscription.select("all", "all")
    end = F.col("eventTime")
    harvests = []
    for i, part in enumerate((end <= first, (end > first) & (end <= second), end > second)):
        if i == 1:
            subscription.stop()
            resumed = Subscription(spark, into, lambda: machines.limit(0), every)
            resumed.resume(subscription.folder)
            subscription = resumed
        into.put(status.where(part), i)
        if subscription.query:
            subscription.query.processAllAvailable()
        harvests.append(subscription.harvest().withColumn("harvest", F.lit(i + 1)))
    subscription.stop()
    return reduce(DataFrame.unionByName, harvests).select(
        F.col("serial_number").cast("bigint").alias("serialNumber"),
        F.col("average_bit_temp_10s").cast("smallint").alias("averageBitTemp10s"),
        F.unix_millis("event_time").alias("eventTime"),
        "harvest",
    )
