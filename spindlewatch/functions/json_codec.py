"""Machine events to and from the JSON text of a topic message."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewatch import schemas

_BAD = "_malformed"
_NUMERIC = [f.name for f in schemas.MACHINE_EVENT if isinstance(f.dataType, T.NumericType)]


def _decoded(messages, value):
    """The messages with the fields of their event, and whether they are malformed.

    The parsed value is unpacked by a generator. Were it a plain column, the filter on it would be pushed
    below it, and every text would be parsed once for the filter and once more for the result.
    """
    with_bad = T.StructType([*schemas.MACHINE_EVENT, T.StructField(_BAD, T.StringType())])
    event = F.from_json(F.col(value), with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    unpacked = messages.select("*", F.inline(F.array(event)))
    # Null, blank and key-less values have no corrupt text of their own, so the key is checked as well.
    return unpacked.withColumn(_BAD, F.col(_BAD).isNotNull() | F.col("serialNum").isNull())


def _event_column(f, missing):
    column = F.col(f.name)
    if missing == "zero" and f.name in _NUMERIC:
        column = F.coalesce(column, F.lit(0).cast(f.dataType))
    return column.alias(f.name)


def decode_events(messages, on_malformed="fail", missing="zero", value="value"):
    """Messages (key, value, timestamp) to events (key, timestamp, and the event's fields).

    A value is malformed if it is not JSON, has a field of the wrong type or out of range, or lacks the
    serial number. ``on_malformed="fail"`` stops the job on one; ``"quarantine"`` leaves them out, and
    :func:`malformed_events` gives them. Missing numbers read as 0, or null with ``missing="null"``.
    """
    if missing not in ("zero", "null"):
        raise ValueError(f"missing must be 'zero' or 'null', not {missing!r}")
    decoded = _decoded(messages, value)
    if on_malformed == "fail":
        # In a filter, so that no column pruning can take the check out of the plan.
        stop = F.raise_error(F.concat(F.lit("malformed event: "), F.coalesce(F.col(value), F.lit("null"))))
        decoded = decoded.where(F.when(F.col(_BAD), stop.cast("boolean")).otherwise(F.lit(True)))
    elif on_malformed == "quarantine":
        decoded = decoded.where(~F.col(_BAD))
    else:
        raise ValueError(f"on_malformed must be 'fail' or 'quarantine', not {on_malformed!r}")
    return decoded.select("key", "timestamp", *[_event_column(f, missing) for f in schemas.MACHINE_EVENT])


def malformed_events(messages, value="value"):
    """The messages that ``decode_events(..., on_malformed="quarantine")`` leaves out."""
    return _decoded(messages, value).where(F.col(_BAD)).select(*messages.columns)


def encode_events(events, timestamp=None):
    """Events to messages: the serial number is the key, the JSON text the value, and the record time is
    the event's own time unless a ``timestamp`` column is named."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.MACHINE_EVENT]
    time = F.col(timestamp) if timestamp else F.timestamp_millis(F.col("eventTime"))
    return events.select(
        F.col("serialNum").cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        time.alias("timestamp"),
    )
