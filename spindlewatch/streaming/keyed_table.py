"""A table that micro-batches put rows into: the whole history, and the newest row per key."""

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewatch.operators.latest import latest_per_key
from spindlewatch.session import session_conf
from spindlewatch.sources.tables import names_in, path_exists, publish_note, read_note, remove, write_note

# Marks a folder as completely written. Spark's own mark can be switched off, and then tells nothing.
MARK = "_put"
ABOUT = "_about"


class KeyedTable:
    """Rows (``key``, ``order``, ...) under ``path``, put there by micro-batches 0, 1, 2, ... of one query.

    A put is an append, so several rows of a key in one batch, late rows and replays need no care: the row
    that counts is the one with the greatest ``order``. A batch that was written already is not written
    again, which makes replays after a failure harmless. As another query counts its batches from 0 again,
    the table keeps the id of the first query that puts into it and refuses every other.

    Batches are kept in groups of ``compact_every``. The last put of a group merges its batches, and writes the
    newest rows so far as a snapshot; both are divided into ``buckets`` by the hash of the key, so that a reader of
    some keys reads their buckets. The group before then loses its batches. So whatever is read is found by its
    number in merged groups, a snapshot and the batches of one group, and no listing grows with the history. How
    groups and buckets are made stays as it was when the table was made.

    A put is one job: its rows are brought together by key and written in files by measured size, of at most
    ``rows_per_file`` rows. Each complete put leaves a mark of its own, which feeds follow.
    """

    def __init__(self, spark, path, schema, key, order, compact_every=50, rows_per_file=1_000_000, buckets=16):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.key = key
        self.order = order
        self.rows_per_file = rows_per_file
        about = self._about() or {}
        self.compact_every = about.get("compact_every", compact_every)
        self.buckets = about.get("buckets", buckets)
        self.marks = f"{self.path}/marks"

    def _about(self):
        note = read_note(self.spark, f"{self.path}/{ABOUT}")
        return json.loads(note) if note else None

    def _check_owner(self):
        """Note the running query as the table's, or refuse it if there is another."""
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        about = self._about()
        if about is None:
            about = {"compact_every": self.compact_every, "buckets": self.buckets, "query": query}
            write_note(self.spark, f"{self.path}/{ABOUT}", json.dumps(about))
        elif about["query"] != query:
            raise ValueError(f"{self.path} was written by query {about['query']}, and not by {query}; use a new table")

    def _group_path(self, kind, group):
        return f"{self.path}/{kind}/group={group:010d}"

    def _batch_path(self, batch_id):
        return f"{self._group_path('history', batch_id // self.compact_every)}/batch={batch_id:012d}"

    def _complete(self, path):
        return path_exists(self.spark, f"{path}/{MARK}")

    def _write(self, rows, path, *parts):
        """Write rows by key and in order, in files by size."""
        writer = rows.hint("rebalance", *(parts or (self.key,))).sortWithinPartitions(*parts, self.key, self.order)
        # Sizes are measured by adaptive execution, which is off where a stream runs its batches.
        with session_conf(rows.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
            writer = writer.write.mode("overwrite").option("maxRecordsPerFile", self.rows_per_file)
            writer.partitionBy(*parts).parquet(path)
        write_note(self.spark, f"{path}/{MARK}", "")

    def last_batch(self):
        """The newest completely written batch, or None."""
        for group in reversed(names_in(self.spark, f"{self.path}/history")):
            for batch in reversed(names_in(self.spark, f"{self.path}/history/{group}")):
                if self._complete(f"{self.path}/history/{group}/{batch}"):
                    return int(batch.split("=")[1])
        return None

    def _read(self, *folders):
        if not folders:
            return self.empty()
        return self.spark.read.schema(self.schema).parquet(*folders).select(*self.schema.names)

    def empty(self):
        return self.spark.createDataFrame([], self.schema)

    def _bucket(self, key):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _bucketed(self, kind, groups, buckets=None, **more):
        """Merged groups or snapshots, or some of their buckets."""
        places = {"group": T.LongType(), "bucket": T.IntegerType()}
        fields = [T.StructField(name, type_) for name, type_ in {**more, **places}.items()]
        rows = self.spark.read.schema(T.StructType([*self.schema, *fields])).option("basePath", f"{self.path}/{kind}")
        rows = rows.parquet(*[self._group_path(kind, g) for g in groups])
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def _bucket_of(self, key):
        typed = F.lit(key).cast(self.schema[self.key].dataType)
        return self.spark.range(1).select(self._bucket(typed)).first()[0]

    def put(self, rows, batch_id):
        """Add the rows of micro-batch ``batch_id``."""
        self._check_owner()
        path = self._batch_path(batch_id)
        if self._complete(path):
            # Computed all the same: the query the rows come from has to bring its state up to this batch.
            rows.write.format("noop").mode("overwrite").save()
        else:
            self._write(rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]), path)
        if (batch_id + 1) % self.compact_every == 0:
            self._close(batch_id // self.compact_every)
        publish_note(self.spark, self.marks, f"batch={batch_id:012d}", str(batch_id))

    def _close(self, group):
        """Merge a group whose last batch was written, and let go of the batches of the group before."""
        first, end = group * self.compact_every, (group + 1) * self.compact_every
        snapshot, merged = self._group_path("snapshot", group), self._group_path("merged", group)
        if not self._complete(snapshot):
            newest = latest_per_key(self._since_snapshot(end - 1), self.key, self.order)
            self._write(newest.withColumn("bucket", self._bucket(self.key)), snapshot, "bucket")
        if not self._complete(merged):
            rows = [self.batch(b).withColumn("batch", F.lit(b).cast("bigint")) for b in range(first, end)]
            whole = reduce(DataFrame.unionByName, rows).withColumn("bucket", self._bucket(self.key))
            self._write(whole, merged, "bucket")
        if group:
            remove(self.spark, self._group_path("history", group - 1))
            for batch in range(first - self.compact_every, first):
                remove(self.spark, f"{self.marks}/batch={batch:012d}")

    def batch(self, batch_id):
        """The rows of one micro-batch."""
        return self.rows_between(batch_id - 1, batch_id)

    def rows_between(self, after, upto, key=None):
        """The rows of the batches behind ``after`` up to ``upto``, of all keys or of one."""
        first = after + 1
        if upto < first:
            return self.empty()
        groups = range(first // self.compact_every, upto // self.compact_every + 1)
        # The group that is still open, and the one closed before it, are there as batches.
        there = set(names_in(self.spark, f"{self.path}/history"))
        closed = [g for g in groups if f"group={g:010d}" not in there]
        parts = []
        if closed:
            buckets = None if key is None else [self._bucket_of(key)]
            merged = self._bucketed("merged", closed, buckets, batch=T.LongType())
            parts.append(merged.where(F.col("batch").between(first, upto)).select(*self.schema.names))
        start = max(first, (closed[-1] + 1) * self.compact_every if closed else 0)
        if start <= upto:
            parts.append(self._read(*[self._batch_path(b) for b in range(start, upto + 1)]))
        rows = reduce(DataFrame.unionByName, parts)
        return rows if key is None else rows.where(F.col(self.key) == F.lit(key))

    def history(self):
        """Every row put so far."""
        last = self.last_batch()
        return self.empty() if last is None else self.rows_between(-1, last)

    def latest(self, before=None, keys=None):
        """The newest row per key, optionally as it was before micro-batch ``before``.

        ``keys``, rows with the key's column, says which keys are asked for: of the snapshot only their buckets are
        read, so other keys may be missing.
        """
        if before is None:
            last = self.last_batch()
            before = 0 if last is None else last + 1
        if before == 0:
            return self.empty()
        return latest_per_key(self._since_snapshot(before - 1, keys), self.key, self.order)

    def _since_snapshot(self, batch_id, keys=None):
        """The last snapshot before the group of ``batch_id``, and that group's rows up to that batch."""
        group = batch_id // self.compact_every
        rows = self.rows_between(group * self.compact_every - 1, batch_id)
        if group == 0:
            return rows
        buckets = None
        if keys is not None:
            buckets = [r[0] for r in keys.select(self._bucket(self.key)).distinct().collect()]
        snapshot = self._bucketed("snapshot", [group - 1], buckets)
        return rows.unionByName(snapshot.select(*self.schema.names))


def put_batches(stream, table, checkpoint, name, trigger, transform=None):
    """Start a query that puts every micro-batch of ``stream`` into ``table``, reshaped by ``transform``."""

    def put(rows, batch_id):
        table.put(transform(rows) if transform else rows, batch_id)

    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(put)
        .start()
    )
