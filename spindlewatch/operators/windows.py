"""Event-time averages per machine."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewatch import names
from spindlewatch.functions.labels import whole_degrees
from spindlewatch.functions.times import to_epoch_ms, utc_timestamp


def tumbling_average(
    events, width=names.WINDOW_WIDTH, lag=names.ALLOWED_LAG, key="serialNum", time="timestamp", value="bitTemp"
):
    """Average of ``value`` per ``key`` and tumbling window: (key, windowEnd in ms, avgTemp).

    Windows are half-open and aligned to the epoch. ``time`` is the record's own time, not a field of its
    payload. On a stream a window is emitted once, when the watermark (newest time seen less ``lag``)
    reaches its end; rows at most ``lag`` behind are never lost.

    The sum is over integers, so it does not depend on the order of the rows. It is reduced before the
    shuffle to one row per key, window and task, so a machine with very many events is not a hot spot.
    """
    end = F.col("window.end")
    if isinstance(events.schema[time].dataType, T.TimestampNTZType):
        if events.isStreaming:
            events = events.withColumn(time, utc_timestamp(F.col(time)))
        else:
            # Reading a zone-less time as UTC is costly, so it is left to the few rows after the aggregation.
            end = utc_timestamp(end)
    if events.isStreaming:
        events = events.withWatermark(time, lag)
    return (
        events.groupBy(F.col(key), F.window(time, width).alias("window"))
        .agg(F.avg(F.col(value).cast("bigint")).alias("avgTemp"))
        .select(key, to_epoch_ms(end).alias("windowEnd"), "avgTemp")
    )


def status_rows(averages, key="serialNum"):
    """Averages as rows of the status table; the row's time is the end of its window."""
    return averages.select(
        F.col(key).alias("serialNumber"),
        whole_degrees(F.col("avgTemp")).alias("averageBitTemp10s"),
        F.col("windowEnd").alias("eventTime"),
    )
