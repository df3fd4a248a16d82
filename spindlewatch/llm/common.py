"""What the operators of this package share: reading tables, written tables, and shipping code to workers."""

import sys
import uuid
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewatch.session import run_dir
from spindlewatch.sources.tables import remove

# What separates words.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# On UTF-8 bytes: A-Z in lower case; and, for words of letters, digits and all beyond ASCII, the rest as spaces.
LOWERED = bytes(range(256)).lower()

# A byte that no UTF-8 text has.
BREAK = b"\xff"
WORDY = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in LOWERED)


def ship(module):
    """Send a module's functions to Python workers by value, so that the package need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


class Shared:
    """A value that goes to every task once, with the classes it is made of; its size must be bounded."""

    def __init__(self, spark, value):
        self.broadcast = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def value(self):
        """A copy of the value, for a task to ask for once."""
        return cloudpickle.loads(self.broadcast.value)



def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Where tables go that are removed before the session ends, if anywhere.
_SCRATCH = ContextVar("scratch", default=None)


def written(df, name):
    """``df`` computed once, kept as Parquet in the cluster's shared folder and read again.

    This cuts the lineage: a lost executor costs no more than the reader's own tasks. The folder lives as
    long as its owner, the shared folder of the session, since results are read from it lazily.
    """
    spark = df.sparkSession
    scratch = _SCRATCH.get()
    path = f"{scratch}/{name}-{uuid.uuid4().hex}" if scratch else run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def distilled(spark, name, make):
    """The table that ``make()`` gives, written; all that is written on the way to it is removed."""
    scratch = run_dir(spark, "scratch")
    before = _SCRATCH.set(scratch)
    try:
        df = make()
        path = run_dir(spark, name)
        df.write.parquet(path)
    finally:
        _SCRATCH.reset(before)
        remove(spark, scratch)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(column):
    """A-Z in lower case, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def crc_remainder(column, divisor):
    """CRC-32 of a value's text, modulo ``divisor``; null is taken as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def words_of(column):
    """Words between white space, as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), f"{SPACE_CLASS}+"), "")


# Rows and bytes of text that a worker looks at together.
SLICE_ROWS = 512
SLICE_BYTES = 8 * 1024 * 1024


def slices(batch, at, rows=SLICE_ROWS):
    """A batch in slices of bounded rows and text bytes (a row is never cut)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= rows or total + size > SLICE_BYTES):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(docs, text, fields, make, keep=None):
    """``docs`` with columns computed from texts in Arrow batches; columns of the same names are replaced.

    ``make()`` is called once per task and gives a function from a list of UTF-8 texts (None for null) to one
    Arrow array per field. ``fields`` is [(name, Arrow type, Spark type)], ``keep`` the columns to keep.
    """
    new = [name for name, _, _ in fields]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("binary").alias("__text"))
    made = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, _, kind in fields))
    schema = T.StructType([*[docs.schema[c] for c in kept], *made])

    def run(batches):
        function = make()
        for batch in batches:
            at = batch.num_columns - 1
            for part in slices(batch, at):
                made = function(part.column(at).to_pylist())
                arrays = [*part.columns[:at], *made]
                names = [*part.schema.names[:at], *new]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema)


def words_in(content):
    """Words between spaces in the order in which they stand, and each ``BREAK`` as one, as an Arrow array."""
    data = np.frombuffer(content, np.uint8)
    breaks = data == BREAK[0]
    filled = data != 0x20
    begins = filled.copy()
    begins[1:] &= ~filled[:-1] | breaks[1:] | breaks[:-1]
    offsets = np.append(np.flatnonzero(begins[filled]), np.count_nonzero(filled)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[filled])])


def list_array(lists, kind):
    """A list array from one flat sequence per row."""
    offsets = [0]
    for one in lists:
        offsets.append(offsets[-1] + len(one))
    flat = [x for one in lists for x in one]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


# Up to this many ids are copied to all tasks.
BROADCAST_IDS = 2_000_000


def copied(stored, limit=BROADCAST_IDS):
    """A stored table of ids, marked to be copied to all tasks if it has at most ``limit`` rows."""
    return F.broadcast(stored) if stored.count() <= limit else stored


def sized(ids, limit=BROADCAST_IDS):
    """A table of ids, written, and :func:`copied` if it is small."""
    return copied(written(ids, "ids"), limit)
