"""The temperature monitor: averages, status table, labels, label changes, control messages."""

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import functions as F

from spindlewatch import names, schemas
from spindlewatch.functions.json_codec import decode_events, malformed_events
from spindlewatch.functions.labels import threshold_label
from spindlewatch.operators.changes import WINDOWS_PER_SLICE, label_changes
from spindlewatch.operators.controls import to_messages
from spindlewatch.operators.lookup import with_limits
from spindlewatch.operators.windows import status_rows, tumbling_average
from spindlewatch.session import session_conf, stream_conf
from spindlewatch.streaming.change_filter import changes_since
from spindlewatch.streaming.feeds import follow
from spindlewatch.streaming.keyed_table import KeyedTable, put_batches

JOB_NAME = "Temperature Monitor"


@dataclass(frozen=True)
class MonitorOptions:
    """Choices the monitor leaves to its user; see the functions that take them."""

    width: str = names.WINDOW_WIDTH
    lag: str = names.ALLOWED_LAG
    on_malformed: str = "fail"
    missing: str = "zero"
    on_missing: str = "fail"  # or "drop", or "unknown"
    refresh: str = "batch"  # profiles as of every micro-batch, or of the "start"
    trigger: tuple = (("processingTime", "10 seconds"),)
    state_partitions: int | None = None  # see stream_conf
    rows_per_file: int = 1_000_000
    compact_every: int = 50
    windows_per_slice: int = WINDOWS_PER_SLICE

    @property
    def slice_span(self):
        """Length of a slice of a machine's history, in ms."""
        return self.windows_per_slice * (pd.Timedelta(self.width) // pd.Timedelta(milliseconds=1))

    def stream_conf(self, spark):
        return stream_conf(spark, self.state_partitions)

    def averages_table(self, spark, path, key, key_type):
        """The keyed table of the averages of a stream."""
        schema = schemas.machine_average(key, key_type)
        return KeyedTable(spark, path, schema, key, "windowEnd", self.compact_every, self.rows_per_file)

    def changes_table(self, spark, path, key, key_type):
        """The keyed table of the label changes of a stream."""
        schema = schemas.label_change(key, key_type)
        return KeyedTable(spark, path, schema, key, "windowEnd", self.compact_every, self.rows_per_file)


def label_averages(averages, profiles, on_missing="fail", key="serialNum"):
    """Averages with the label of their machine's limits."""
    limited = with_limits(averages, profiles, "keep" if on_missing == "unknown" else on_missing, key)
    label = threshold_label(F.col("avgTemp"), F.col("warningTemp"), F.col("criticalTemp"))
    if on_missing == "unknown":
        label = F.coalesce(label, F.lit(names.UNKNOWN))
    return limited.withColumn("label", label)


def monitored_changes(events, profiles, options=MonitorOptions(), key="serialNum"):
    """The whole monitor on stored events, as one plan: (key, windowEnd, avgTemp, label) of every change."""
    averages = tumbling_average(events, options.width, options.lag, key)
    labelled = label_averages(averages, profiles, options.on_missing, key)
    return label_changes(
        labelled.select(key, "windowEnd", "avgTemp", "label"), key, slice_span=options.slice_span
    )


class TemperatureMonitor:
    """The monitor on a stream of events, as one query.

    The averages are computed once. Each micro-batch of them is written to the averages table, and labels
    are derived from what was written, so neither the aggregation nor its state runs twice for the two uses.
    ``profiles`` is a function without arguments that gives the profile table. ``publish`` is called with
    every micro-batch of control messages (key, value) and its id, at least once each.
    """

    def __init__(self, spark, root, profiles, publish, options=MonitorOptions(), key="serialNum", key_type="string"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.profiles = profiles
        self.publish = publish
        self.options = options
        self.key = key
        self.averages = options.averages_table(spark, f"{self.root}/averages", key, key_type)
        self.changes = options.changes_table(spark, f"{self.root}/changes", key, key_type)

    def decode(self, messages, quarantine=None):
        """Events of a stream of messages. Where malformed ones are left out, ``quarantine`` is called with the
        stream of them, and has to start a query that keeps them."""
        if self.options.on_malformed == "quarantine":
            if quarantine is None:
                raise ValueError("malformed messages are left out, so there must be a quarantine that keeps them")
            quarantine(malformed_events(messages))
        return decode_events(messages, self.options.on_malformed, self.options.missing)

    def start(self, events):
        """Start the query on decoded events (key, timestamp, bitTemp)."""
        averages = tumbling_average(events, self.options.width, self.options.lag, self.key)
        started_with = None if self.options.refresh == "batch" else self.profiles()

        def step(rows, batch_id):
            self.averages.put(rows, batch_id)
            profiles = self.profiles() if started_with is None else started_with
            self.label_batch(profiles, batch_id)

        with session_conf(self.spark, self.options.stream_conf(self.spark)):
            return (
                averages.writeStream.queryName(JOB_NAME)
                .option("checkpointLocation", f"{self.root}/checkpoint")
                .trigger(**dict(self.options.trigger))
                .foreachBatch(step)
                .start()
            )

    def label_batch(self, profiles, batch_id):
        """Label one written micro-batch, and note and publish the changes."""
        averages = self.averages.batch(batch_id)
        labelled = label_averages(averages, profiles, self.options.on_missing, self.key)
        put_changes(self.changes, labelled, batch_id, self.options, keys=averages)
        self.publish(to_messages(self.changes.batch(batch_id), self.key), batch_id)

    def status(self):
        """The status table: the newest row per machine."""
        return status_rows(self.averages.latest(), self.key)

    def status_history(self):
        """Every status row ever put."""
        return status_rows(self.averages.history(), self.key)

    def follow_status(self, then, root, trigger, key=None, since=-1):
        """Start a query that calls ``then`` with the status rows that are put, of all machines or of one, and a
        number; see :func:`spindlewatch.streaming.feeds.follow`."""
        hand_on = lambda rows, number: then(status_rows(rows, self.key), number)
        return follow(self.averages, hand_on, root, f"{JOB_NAME} feed", trigger, since, key)


def put_changes(changes, labelled, batch_id, options, keys=None):
    """Put the label changes of one micro-batch of labelled averages into the table of changes.

    ``keys``, stored rows with the machines of the batch, keeps the part of the table that is read to theirs.
    """
    last = changes.latest(before=batch_id, keys=keys)
    changes.put(changes_since(last, labelled, changes.key, slice_span=options.slice_span), batch_id)


def start_status_query(spark, events, root, options=MonitorOptions(), key="serialNum", key_type="string"):
    """The status branch as a query of its own. Returns (query, averages table)."""
    table = options.averages_table(spark, f"{root}/averages", key, key_type)
    with session_conf(spark, options.stream_conf(spark)):
        averages = tumbling_average(events, options.width, options.lag, key)
        query = put_batches(
            averages, table, f"{root}/checkpoint-status", f"{JOB_NAME} status", dict(options.trigger)
        )
    return query, table


def start_label_query(
    spark, events, profiles, root, options=MonitorOptions(), key="serialNum", key_type="string", publish=None
):
    """The label branch as a query of its own, with the profiles as of now. Returns (query, table of changes).

    ``publish``, if given, is called with every micro-batch of control messages and its id, at least once.
    """
    table = options.changes_table(spark, f"{root}/changes", key, key_type)

    def step(rows, batch_id):
        put_changes(table, rows, batch_id, options)
        if publish:
            publish(to_messages(table.batch(batch_id), key), batch_id)

    with session_conf(spark, options.stream_conf(spark)):
        averages = tumbling_average(events, options.width, options.lag, key)
        query = (
            label_averages(averages, profiles, options.on_missing, key)
            .writeStream.queryName(f"{JOB_NAME} labels")
            .option("checkpointLocation", f"{root}/checkpoint-labels")
            .trigger(**dict(options.trigger))
            .foreachBatch(step)
            .start()
        )
    return query, table
