"""Keyed message streams: (key, value, timestamp), from Kafka or from files of the same shape."""

from pyspark.sql import functions as F

from spindlewatch import schemas


def kafka_options(servers, topic, starting="latest", max_per_trigger=None):
    """Reader options of a topic. New messages only, unless told to start elsewhere."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_messages(spark, servers, topic, starting="latest", max_per_trigger=None):
    """Stream a topic. Event time is the record's own timestamp. Needs the Kafka connector on the class path."""
    records = (
        spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, max_per_trigger)).load()
    )
    return records.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp"
    )


def file_messages(spark, path, fmt="parquet", schema=schemas.MESSAGE, max_files_per_trigger=None, **options):
    """Stream a folder that files of messages (or of any declared ``schema``) are dropped into.

    ``max_files_per_trigger`` bounds a micro-batch, and with it the state touched at once; without it the
    first batch of a backfill takes everything that is there.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.options(**options).load(path)


def stream_table(spark, path, **options):
    """Stream a stored parquet table, given as a folder or as a single file."""
    schema = spark.read.parquet(path).schema
    # As a pattern, a path may name a single file, which the file stream otherwise refuses.
    parent, _, name = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(schema).options(**options).parquet(f"{parent}/{{{name}}}")
