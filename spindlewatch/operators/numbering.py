"""Consecutive numbers for rows, without passing them through one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

SLICE_BITS = 16


def dense_index(df, order, index, bounds=None, bits=SLICE_BITS):
    """Number the rows of ``df`` 0, 1, 2, ... by ``order``, a unique 64-bit integer column.

    Rows are numbered inside slices of ``2**bits`` consecutive values of ``order``, and each slice starts
    at the number of rows in the slices before. If there may be more than ``2**bits`` slices, the starts are
    found the same way, on counts instead of rows. ``bounds`` (least and greatest ``order``) tells how many
    there may be; it is looked up if not given.
    """
    low, high = bounds or df.agg(F.min(order), F.max(order)).first()
    if low is None:
        return df.withColumn(index, F.lit(0).cast("bigint"))
    width = ((high >> bits) - (low >> bits)).bit_length()
    sliced = df.withColumn("_slice", F.shiftright(F.col(order), bits))
    counts = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    within = Window.partitionBy("_slice").orderBy(order)
    return (
        sliced.withColumn(index, F.row_number().over(within).cast("bigint") - 1)
        .join(_starts(counts, "_slice", width, bits), "_slice")
        .withColumn(index, F.col(index) + F.col("_start"))
        .select(*df.columns, index)
    )


def nth_smallest(df, column, n, bits=SLICE_BITS):
    """The ``n``-th smallest (from 1) of the values of ``column``, a unique 64-bit integer; None if there are fewer.

    The values are counted in at most ``2**bits`` ranges; the range that holds the ``n``-th is counted in
    ranges again, until a range is one value. Only those counts come to the driver, and each count reads only
    the range it is about.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return None
    while True:
        shift = max(0, (high - low).bit_length() - bits)
        within = df.where(F.col(column).between(F.lit(low), F.lit(high)))
        # The difference of two 64-bit numbers need not be one, the difference of halves is.
        part = F.shiftright(F.col(column), shift) - F.lit(low >> shift)
        counts = within.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()
        for row in sorted(counts):
            if n <= row.rows:
                break
            n -= row.rows
        else:
            return None
        start = ((low >> shift) + row.part) << shift
        low, high = max(low, start), min(high, start + (1 << shift) - 1)
        if low == high:
            return low


def _starts(counts, slice_column, width, bits):
    """Rows before each slice: (slice, _start). Slice numbers differ by less than ``2**width``."""
    before = Window.orderBy(slice_column).rowsBetween(Window.unboundedPreceding, -1)
    if width <= bits:
        # At most 2**bits counts are left, and only here one task sees all of them.
        return counts.select(slice_column, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    parent = f"{slice_column}p"
    grouped = counts.withColumn(parent, F.shiftright(F.col(slice_column), bits))
    totals = grouped.groupBy(parent).agg(F.sum("_rows").alias("_rows"))
    starts = _starts(totals, parent, width - bits + 1, bits).withColumnRenamed("_start", "_parent_start")
    inside = Window.partitionBy(parent).orderBy(slice_column).rowsBetween(Window.unboundedPreceding, -1)
    return (
        grouped.withColumn("_start", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
        .join(starts, parent)
        .select(slice_column, (F.col("_start") + F.col("_parent_start")).alias("_start"))
    )
