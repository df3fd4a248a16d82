"""Label changes by Spark's own keyed state: one value per machine, with a time to live."""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from spindlewatch.session import stream_conf

# Workers get the class by value, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def state_conf(spark, state_partitions=None):
    """Settings to start a query with :func:`stateful_label_changes` under."""
    return {**stream_conf(spark, state_partitions), "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


class LastLabel(StatefulProcessor):
    """Keeps the last label of a machine, and hands on the rows whose label is another one.

    The rows of a machine in a micro-batch come in frames; they are compared as columns, and the state is read and
    written once. ``ttl`` is in ms.
    """

    def __init__(self, order, label, ttl):
        self.order, self.label, self.ttl = order, label, ttl

    def init(self, handle):
        schema = T.StructType([T.StructField("label", T.StringType())])
        self.last = handle.getValueState("last", schema, self.ttl)

    def handleInputRows(self, key, frames, timers):
        rows = pd.concat(list(frames), ignore_index=True)
        rows = rows[rows[self.label].notna()].sort_values(self.order, kind="stable")
        if not len(rows):
            return
        known = self.last.get() if self.last.exists() else None
        previous = rows[self.label].shift(fill_value=known[0] if known is not None else "")
        self.last.update((rows[self.label].iloc[-1],))
        changed = rows[rows[self.label] != previous]
        if len(changed):
            yield changed

    def close(self):
        pass


def stateful_label_changes(labelled, key="serialNum", order="windowEnd", label="label", ttl=None):
    """The rows of a stream whose ``label`` is not the last one of their ``key``, as
    :func:`spindlewatch.operators.changes.label_changes` has them on stored rows.

    Rows of a key must come in the order of ``order`` from one micro-batch to the next, as windows do; within a batch
    they may come in any. Rows without a label are passed over. State stays in Spark's state store, which must be
    RocksDB. ``ttl`` (ms of processing time) lets the label of a machine expire that has not been heard of for so long;
    its next label is then a change whatever it is. Without it labels stay.

    A query with this operator has to be started under :func:`state_conf`: Spark would run micro-batches without rows
    for it without end. As windows are closed by just such batches, averages are best a query of their own whose
    output this one streams.

    All rows of a key in one micro-batch are handled by one task. Where one machine has a large share of a
    backfill, the table-based form (:func:`spindlewatch.streaming.change_filter.changes_since`) divides it.
    """
    rows = labelled.select(key, order, label)
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=LastLabel(order, label, ttl),
        outputStructType=rows.schema,
        outputMode="Update",
        timeMode="None" if ttl is None else "ProcessingTime",
    )
