"""Declared schemas of the records. Nothing is inferred at run time."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns):
    """A schema from ``name type, name type, ...``; unlike Spark's own parser it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# One topic record, as the Kafka source gives it after casting key and value to text.
MESSAGE = _struct("key string, value string, timestamp timestamp")

# The JSON value of a telemetry message, in field order.
MACHINE_EVENT = _struct(
    "serialNum string, eventTime bigint, bitRPM int, bitTemp smallint, "
    "bitPositionX int, bitPositionY int, bitPositionZ int"
)

MACHINE_PROFILE = _struct(
    "serialNum string, location string, block string, faultyOdds float, manufacturer string, "
    "warningTemp smallint, criticalTemp smallint, maxRPM int"
)

# eventTime is the end of the window, in ms since the epoch.
def machine_status(key_type="string"):
    return _struct(f"serialNumber {key_type}, averageBitTemp10s smallint, eventTime bigint")


MACHINE_STATUS = machine_status()


def machine_average(key="serialNum", key_type="string"):
    """Exact averages: what the status rows and the labels are both derived from."""
    return _struct(f"{key} {key_type}, windowEnd bigint, avgTemp double")


def label_change(key="serialNum", key_type="string"):
    return _struct(f"{key} {key_type}, windowEnd bigint, label string")


CONTROL_MESSAGE = _struct("key string, value string")

# Append-only: the newest row of a key (by loggedAt) is its value.
ACTIVITY = _struct("key string, value string, loggedAt timestamp")

MONITOR_ROW = _struct("serial_number string, average_bit_temp_10s int, event_time timestamp")
