"""Scalar rules of the temperature monitor."""

from pyspark.sql import functions as F

from spindlewatch import names


def threshold_label(temperature, warning, critical):
    """red above ``critical``, orange above ``warning``, else green. Both comparisons are strict.

    Without both limits and a temperature there is no label (null); in particular it is not green.
    """
    known = temperature.isNotNull() & warning.isNotNull() & critical.isNotNull()
    return (
        F.when(~known, F.lit(None).cast("string"))
        .when(temperature > critical, names.RED)
        .when(temperature > warning, names.ORANGE)
        .otherwise(names.GREEN)
    )


def whole_degrees(average):
    """The average as a 16-bit integer, cut off toward zero."""
    return average.cast("smallint")


def critical_limit(warning):
    """The critical limit that belongs to a warning limit."""
    return (warning + F.lit(names.CRITICAL_MARGIN)).cast("smallint")
