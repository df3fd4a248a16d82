"""Profile templates: lines of ``location,block,faulty fraction``, without header or quoting."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spindlewatch.functions.text import comma_fields, float_or_null

WRONG_FIELD_COUNT = "field count"
WRONG_NUMBER = "number"


def read_lines(spark, path):
    """Lines of text files, with ``line``, their number from 0: files in the order of their paths, lines in file
    order. Files are read in parts wherever Spark splits them; only the parts are put in order in one place.
    """
    rows = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_part"),
        F.monotonically_increasing_id().alias("_id"),
    )
    parts = rows.groupBy("_file", "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.orderBy("_file", "_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_start", F.coalesce(F.sum("_lines").over(before), F.lit(0))).drop("_lines")
    line = (F.col("_start") + F.col("_id") - F.col("_first")).alias("line")
    return rows.join(starts, ["_file", "_part"]).select("value", line)


def _checked(lines):
    fields = comma_fields(F.col("value"))
    parsed = lines.where(F.length("value") > 0).withColumn("_fields", fields)
    number = float_or_null(F.try_element_at("_fields", F.lit(3)))
    return parsed.withColumn("_fraction", number).withColumn(
        "reason",
        F.when(F.size("_fields") != 3, WRONG_FIELD_COUNT).when(F.col("_fraction").isNull(), WRONG_NUMBER),
    )


def accepted_templates(lines):
    """Templates on the well-formed lines; other columns of ``lines`` are kept."""
    others = [c for c in lines.columns if c != "value"]
    return (
        _checked(lines)
        .where("reason is null")
        .select(
            *others,
            F.col("_fields")[0].alias("location"),
            F.col("_fields")[1].alias("block"),
            F.col("_fraction").alias("faultyFraction"),
        )
    )


def rejected_lines(lines):
    """Lines that are neither empty nor templates, with the reason."""
    return _checked(lines).where("reason is not null").select(*lines.columns, "reason")
