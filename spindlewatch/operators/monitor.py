"""Following the machines of one location and block."""

from pyspark.sql import functions as F

from spindlewatch.functions.times import from_epoch_ms


def is_blank(value):
    return value is None or len(value) == 0


def matching_machines(profiles, location, block, key="serialNum"):
    """Keys of the machines at ``location`` and ``block``; no rows if either is blank.

    The values are compared as values, so quotes in them mean nothing.
    """
    if is_blank(location) or is_blank(block):
        return profiles.select(key).where(F.lit(False))
    return profiles.where((F.col("location") == F.lit(location)) & (F.col("block") == F.lit(block))).select(key)


def match_count(profiles, location, block, key="serialNum"):
    """How many machines match, as one row."""
    return matching_machines(profiles, location, block, key).agg(F.count(F.lit(1)).alias("matches"))


def status_of(status, machines, status_key="serialNumber", key="serialNum"):
    """Status rows of the given machines; works on a stream of status rows too."""
    return status.join(machines, status[status_key] == machines[key], "left_semi")


def monitor_rows(status):
    """Status rows in the monitor's columns and types."""
    return status.select(
        F.col("serialNumber").cast("string").alias("serial_number"),
        F.col("averageBitTemp10s").cast("int").alias("average_bit_temp_10s"),
        from_epoch_ms(F.col("eventTime")).alias("event_time"),
    )


def accumulate(collected, harvest):
    """All rows collected so far and the new ones, duplicates included."""
    return collected.unionByName(harvest)
