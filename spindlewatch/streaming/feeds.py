"""Change feeds of keyed tables, and subscriptions that follow a selection of machines."""

import json

from pyspark.sql import functions as F

from spindlewatch import names, schemas
from spindlewatch.operators.monitor import is_blank, matching_machines, monitor_rows, status_of
from spindlewatch.session import run_dir
from spindlewatch.sources.tables import path_exists, read_note, write_note
from spindlewatch.streaming.progress import Progress

ABOUT = "_about"


def follow(table, then, root, name, trigger, since=-1, key=None):
    """Start a query that hands on what is put into a keyed table: every insert and update, of all keys or of one.

    ``then`` is called with rows and a number 0, 1, 2, ...; each call gets the batches put since the one before,
    the first those behind batch ``since``. A row counts as an update even if the value is the one from before.
    After a failure the last call is made again with the same number and rows, so ``then`` should replace what it
    made of that number. The query streams the marks of complete puts, and which batches a call got is noted under
    ``root``; started again on the same ``root`` it goes on from there, and ``since`` is not looked at.

    What it reads is found by number: a reader that has fallen behind misses nothing, and no listing grows with the
    history. Of closed groups a feed of one key reads the files of that key's bucket.
    """
    spark = table.spark
    about = f"{root}/{ABOUT}"
    if not path_exists(spark, about):
        write_note(spark, about, json.dumps({"since": since}))
    since = json.loads(read_note(spark, about))["since"]
    progress = Progress(spark, f"{root}/progress")

    def step(marks, batch_id):
        before = progress.upto(batch_id - 1)
        before = since if before is None else before
        upto = progress.upto(batch_id)
        if upto is None:
            newest = marks.agg(F.max(F.col("value").cast("bigint")).alias("batch")).first().batch
            upto = before if newest is None else max(before, newest)
            progress.note(batch_id, upto)
        then(table.rows_between(before, upto, key), batch_id)

    marks = spark.readStream.schema("value string").text(_folder(spark, table.marks))
    return (
        marks.writeStream.queryName(name)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**trigger)
        .foreachBatch(step)
        .start()
    )


def _folder(spark, path):
    """A folder to stream, which has to be there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)
    return path


class Harvest:
    """Numbered batches of rows under ``path``, and a reader's position in them.

    ``put`` is a target for :func:`follow`. ``take`` gives the rows that have come since it was last called, by this
    object or by another one on the same folder and for the same ``reader``, before a restart or now: every row is
    taken once. Readers of different names each take everything.
    """

    def __init__(self, spark, path, schema, reader="default"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.written = Progress(spark, f"{self.path}/written")
        self.taken = Progress(spark, f"{self.path}/taken/{reader}")

    def _batch_path(self, number):
        return f"{self.path}/rows/batch={number:012d}"

    def put(self, rows, number):
        """Write the rows of one batch, instead of what was there of it."""
        if self.written.last() >= number:
            return
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        typed.write.mode("overwrite").parquet(self._batch_path(number))
        self.written.note(number, number)

    def _between(self, after, upto):
        folders = [self._batch_path(n) for n in range(after + 1, upto + 1)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders).select(*self.schema.names)

    def _position(self, step):
        upto = self.taken.upto(step)
        return -1 if upto is None else upto

    def all(self):
        """Everything that has come so far, taken or not."""
        return self._between(-1, self.written.last())

    def take(self):
        """Rows that have come since the last call."""
        while True:
            step, upto = self.taken.last(), self.written.last()
            after = self._position(step)
            if upto <= after:
                return self._between(0, 0)
            try:
                self.taken.note(step + 1, upto)
            except FileExistsError:
                # Another reader of this name was faster, and has these rows.
                continue
            return self._between(after, upto)

    def again(self):
        """The rows of the last call of :meth:`take` that gave any, for a reader that died before it was done."""
        step = self.taken.last()
        return self._between(self._position(step - 1), self._position(step))


class Subscription:
    """Follows the machines of one location and block; a new selection replaces the one before.

    ``status`` is the keyed table that status rows are put into, and ``as_status`` turns its rows into status
    rows, if they are not; ``profiles`` is a function without arguments that gives the current profiles. The
    set of machines is fixed when a selection is made. Results go to a new folder with every selection, so
    they start empty, and by default only what is put after the selection shows; with ``start="earliest"``
    all that was put before does, too.
    """

    def __init__(self, spark, status, profiles, trigger=None, as_status=None, start="now"):
        if start not in ("now", "earliest"):
            raise ValueError(f"start must be 'now' or 'earliest', not {start!r}")
        self.spark = spark
        self.status = status
        self.as_status = as_status or (lambda rows: rows)
        self.start = start
        self.profiles = profiles
        self.trigger = trigger or {"processingTime": names.HARVEST_INTERVAL}
        self.folder = None
        self.query = None
        self._harvest = None

    def select(self, location, block):
        """Follow ``location`` and ``block``, and return how many machines that are.

        A blank value matches nothing and leaves the present selection as it is.
        """
        if is_blank(location) or is_blank(block):
            return 0
        self.stop()
        since = -1
        if self.start == "now":
            last = self.status.last_batch()
            since = -1 if last is None else last
        folder = run_dir(self.spark, "subscription")
        matching_machines(self.profiles(), location, block).write.parquet(f"{folder}/machines")
        return self._follow(folder, f"monitor-{location}-{block}", since)

    def resume(self, folder):
        """Go on with a selection made by a subscription that had this ``folder``, and return how many machines it has."""
        self.stop()
        return self._follow(folder, f"monitor-{folder.rsplit('/', 1)[-1]}", -1)

    def _follow(self, folder, name, since):
        machines = self.spark.read.parquet(f"{folder}/machines")
        count = machines.count()
        self.folder = folder
        self._harvest = Harvest(self.spark, f"{folder}/harvest", schemas.MONITOR_ROW)
        if count:

            def keep(rows, number):
                self._harvest.put(monitor_rows(status_of(self.as_status(rows), machines)), number)

            self.query = follow(self.status, keep, f"{folder}/feed", name, self.trigger, since)
        return count

    def results(self):
        """Everything that has come since the selection was made."""
        return self.spark.createDataFrame([], schemas.MONITOR_ROW) if self._harvest is None else self._harvest.all()

    def harvest(self):
        """What has come since the last harvest of this selection, also if that was before a restart."""
        return self.spark.createDataFrame([], schemas.MONITOR_ROW) if self._harvest is None else self._harvest.take()

    def stop(self):
        if self.query is not None:
            self.query.stop()
            self.query = None


def late_rows(query):
    """Rows dropped because their window was closed, over the micro-batches of the query's recent progress."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
