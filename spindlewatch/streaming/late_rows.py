"""Counting what a query drops as late, over its whole life."""

import json
import time

from pyspark.sql.streaming import StreamingQueryListener

from spindlewatch.sources.notes import Notes


class LateRows(StreamingQueryListener):
    """Adds up what the stateful operators of the query called ``name`` drop because their window was closed.

    The sum is noted under ``path``, best beside the query's checkpoint, with the micro-batch that it goes up to, so it
    goes on over restarts and does not depend on how many batches a query's own progress retains. A batch that is
    run again replaces its own share. Spark counts rows as they reach the operator: events of one machine and window
    that a task has already added up count as one. The number of a batch is known when Spark reports its progress,
    shortly after it was committed; a process that dies between the two leaves that batch out.
    """

    def __init__(self, spark, name, path):
        self.spark = spark
        self.name = name
        self.notes = Notes(spark, path, keep=2)
        self.reported = -1

    def _noted(self, step):
        text = self.notes.text(step)
        return json.loads(text) if text else {"batch": -1, "total": 0}

    def total(self):
        """Rows dropped in all batches that were reported so far."""
        return self._noted(self.notes.last())["total"]

    def add(self, batch, dropped):
        step = self.notes.last()
        last = self._noted(step)
        if last["batch"] >= batch:
            # Run again: what was noted for this batch no longer counts.
            step -= 1
            last = self._noted(step)
            self.notes.replace(step + 1, json.dumps({"batch": batch, "total": last["total"] + dropped}))
        elif dropped:
            self.notes.add(step + 1, json.dumps({"batch": batch, "total": last["total"] + dropped}))

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if event.progress.name == self.name:
            dropped = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
            self.add(event.progress.batchId, dropped)
            self.reported = event.progress.batchId

    def await_batch(self, batch, seconds=60):
        """Wait until a batch has been reported, since reports come a little after the batch."""
        end = time.monotonic() + seconds
        while self.reported < batch:
            if time.monotonic() > end:
                raise TimeoutError(f"batch {batch} of {self.name} was not reported in {seconds} s")
            time.sleep(0.05)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def count_late_rows(spark, name, path):
    """Begin to count; to be called before the query is started. ``spark.streams.removeListener`` ends it."""
    listener = LateRows(spark, name, path)
    spark.streams.addListener(listener)
    return listener
