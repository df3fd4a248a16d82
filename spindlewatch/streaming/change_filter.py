"""Label changes on a stream: one micro-batch is compared with the last change of every machine."""

from pyspark.sql import functions as F

from spindlewatch.operators.changes import SLICE_SPAN, label_changes


def changes_since(last, rows, key="serialNum", order="windowEnd", label="label", slice_span=SLICE_SPAN):
    """Rows of one micro-batch whose label is new, given ``last``, the newest change per key so far.

    Rows without a label are left out, as everywhere. ``slice_span`` is as in
    :func:`spindlewatch.operators.changes.label_changes`, and has no influence on the result.
    """
    known = last.select(key, F.col(label).alias("_known"))
    joined = rows.select(key, order, label).join(known, key, "left")
    first = F.coalesce(F.col("_known"), F.lit(""))
    return label_changes(joined, key, order, label, first, slice_span).drop("_known")
