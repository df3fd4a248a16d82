"""Control messages and what the controller does about them."""

from pyspark.sql import functions as F

from spindlewatch import names
from spindlewatch.functions.text import control_line
from spindlewatch.operators.lookup import with_faulty_odds

# What the controller does on a label. Orange is published but not acted on.
ACTIONS = {names.RED: "reduce speed", names.GREEN: "resume normal speed"}


def to_messages(rows, key="serialNum", value="label", timestamp=None):
    """Rows as topic messages (key, value), with a record time if one is named."""
    columns = [F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value")]
    if timestamp:
        columns.append(F.col(timestamp).alias("timestamp"))
    return rows.select(*columns)


def actionable(controls, value="value"):
    """The messages the controller acts on."""
    return controls.where(F.col(value).isin(*ACTIONS))


def with_action(controls, key="key", value="value"):
    """Adds ``action`` and the controller's log ``line``; messages it ignores are left out."""
    action = F.when(F.col(value) == names.RED, ACTIONS[names.RED]).when(
        F.col(value) == names.GREEN, ACTIONS[names.GREEN]
    )
    return (
        actionable(controls, value)
        .withColumn("action", action)
        .withColumn("line", control_line(F.col(key).cast("string"), F.col(value)))
    )


def routed(controls, machines, profiles, key="key"):
    """Actions on known machines. ``faultyOdds`` decides how a machine resumes: its profile's, or the default.

    ``machines`` has one row per running machine (column ``serialNum``). For messages to other machines
    see :func:`spindlewatch.operators.lookup.unmatched_keys`.
    """
    known = with_action(controls, key).withColumnRenamed(key, "serialNum").join(
        machines.select("serialNum"), "serialNum", "left_semi"
    )
    return with_faulty_odds(known, profiles)
