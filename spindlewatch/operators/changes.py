"""Rows whose label differs from the one before, per key."""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Windows of one machine that a single task may have to look at in a row.
WINDOWS_PER_SLICE = 50_000
SLICE_SPAN = WINDOWS_PER_SLICE * 10_000


def label_changes(df, key="serialNum", order="windowEnd", label="label", initial="", slice_span=SLICE_SPAN):
    """Rows of ``df`` whose ``label`` is not the label of the previous row of the same ``key``.

    The first row of a key is compared with ``initial``, a text or a column. ``order`` is a number unique
    within a key. A row without a label says nothing: it is left out before rows are compared, so it is neither
    a change itself nor does it make the next row one.

    The history of a key is cut into slices of ``slice_span`` (in units of ``order``), so that no task gets
    the whole history of a busy machine: rows are compared inside (key, slice), and only the one row that
    opens a slice is compared across slices, with the last label of the slice before. Per key that second
    comparison sees one row per slice. With ``order`` in ms and windows of ``w`` ms a slice holds at most
    ``slice_span / w`` rows; the default suits windows of 10 s.

    ``slice_span=None`` leaves histories whole, for rows known to span no more than a slice would.
    """
    first = initial if isinstance(initial, Column) else F.lit(initial)
    df = df.where(F.col(label).isNotNull())
    if slice_span is None:
        previous = F.lag(label).over(Window.partitionBy(key).orderBy(order))
        compared = df.withColumn("_previous", F.coalesce(previous, first))
        return compared.where(F.col(label) != F.col("_previous")).select(*df.columns)

    in_slice = Window.partitionBy(key, "_slice").orderBy(order)
    whole_slice = in_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The exchange is explicit, so that a plan that arrives partitioned by the key alone is cut as well.
    candidates = (
        df.withColumn("_slice", F.floor(F.col(order) / F.lit(slice_span)))
        .repartition(key, "_slice")
        .withColumn("_opens", F.lag(order).over(in_slice).isNull())
        .withColumn("_previous", F.lag(label).over(in_slice))
        .withColumn("_last", F.last(label).over(whole_slice))
        .where(F.col("_opens") | (F.col(label) != F.col("_previous")))
    )
    # The opening rows of a key come together; its other rows stay apart by slice and are passed through.
    openings = Window.partitionBy(key, F.when(~F.col("_opens"), F.col("_slice"))).orderBy("_slice")
    return (
        candidates.withColumn("_before", F.coalesce(F.lag("_last").over(openings), first))
        .where(~F.col("_opens") | (F.col(label) != F.col("_before")))
        .select(*df.columns)
    )
