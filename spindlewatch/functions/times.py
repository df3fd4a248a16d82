"""Epoch milliseconds and timestamps."""

from pyspark.sql import functions as F


def to_epoch_ms(timestamp):
    """Timestamp to ms since the epoch."""
    return F.unix_millis(timestamp)


def from_epoch_ms(ms):
    """Ms since the epoch to timestamp."""
    return F.timestamp_millis(ms)


def utc_timestamp(wall_clock):
    """A zone-less timestamp read as UTC, whatever the session's time zone is.

    Event-time columns must be of type TIMESTAMP: the streaming watermark refuses TIMESTAMP_NTZ.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, wall_clock))
