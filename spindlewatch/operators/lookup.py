"""Look-ups in the profile table.

No join here is told to broadcast: Catalyst and adaptive execution do so when the measured size of the
profiles allows it, and otherwise shuffle and split skewed partitions of the left side, which is safe since
a profile's key is unique.
"""

from pyspark.sql import functions as F

from spindlewatch import names


def with_limits(averages, profiles, on_missing="fail", key="serialNum"):
    """Averages with the limits of their machine: adds ``warningTemp`` and ``criticalTemp``.

    ``on_missing`` decides about a machine without limits: ``"fail"`` stops the job, ``"drop"`` leaves
    the row out, ``"keep"`` keeps it with null limits.
    """
    limits = profiles.select(key, "warningTemp", "criticalTemp")
    if on_missing == "drop":
        return averages.join(limits, key).where("warningTemp is not null and criticalTemp is not null")
    if on_missing not in ("fail", "keep"):
        raise ValueError(f"on_missing must be 'fail', 'drop' or 'keep', not {on_missing!r}")
    joined = averages.join(limits, key, "left")
    if on_missing == "keep":
        return joined
    absent = F.col("warningTemp").isNull() | F.col("criticalTemp").isNull()
    stop = F.raise_error(F.concat(F.lit("no limits for machine "), F.col(key).cast("string")))
    return joined.where(F.when(absent, stop.cast("boolean")).otherwise(F.lit(True)))


def with_faulty_odds(rows, profiles, default=names.DEFAULT_FAULTY_ODDS, key="serialNum"):
    """Rows with the fault odds of their machine, and ``default`` where there is no profile."""
    odds = profiles.select(key, "faultyOdds")
    return rows.join(odds, key, "left").withColumn(
        "faultyOdds", F.coalesce("faultyOdds", F.lit(default).cast("float"))
    )


def unmatched_keys(rows, profiles, key="serialNum"):
    """Keys of ``rows`` without a profile, with their row counts.

    Where the profiles are shuffled, rows are counted before the join. Where they are small enough to go to
    every task, Spark joins first and counts what is left, without a shuffle of the rows either way.
    """
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(profiles.select(key), key, "left_anti")
