"""Topic, console and line-log sinks, and tees."""

from pyspark.sql import functions as F

from spindlewatch.sources.tables import path_exists


def message_batch_sink(fmt, topic=None, servers=None, path=None):
    """A function (messages, batch id) that appends one micro-batch of (key, value) to a topic or folder.

    Delivery to a topic is at least once. A folder gets one sub-folder per micro-batch, so a replayed batch
    replaces itself.
    """

    def to_kafka(messages, batch_id):
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    def to_files(messages, batch_id):
        messages.write.format(fmt).mode("overwrite").save(f"{path}/batch={batch_id:012d}")

    return to_kafka if fmt == "kafka" else to_files


def write_messages(stream, checkpoint, name, trigger, fmt, topic=None, servers=None, path=None):
    """Start a query that publishes a stream of (key, value)."""
    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(**trigger)
    if fmt == "kafka":
        writer = writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    else:
        writer = writer.format(fmt).option("path", path)
    return writer.start()


def console_lines(stream, line, checkpoint, name, trigger):
    """Start a query that prints one line per row."""
    return (
        stream.select(line.alias("line"))
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .option("truncate", "false")
        .trigger(**trigger)
        .format("console")
        .start()
    )


def _log_folder(spark, folder, name):
    if not path_exists(spark, folder):
        raise ValueError(f"log folder {folder!r} does not exist")
    return f"{folder}/{name}"


def log_lines(df, name, folder, line):
    """Write one UTF-8 line per row under ``folder``, which must exist. Earlier lines of ``name`` go."""
    df.select(line.alias("value")).write.mode("overwrite").text(_log_folder(df.sparkSession, folder, name))


def log_stream(stream, name, folder, line, checkpoint, trigger):
    """Start a query that appends one line per row."""
    path = _log_folder(stream.sparkSession, folder, name)
    return (
        stream.select(line.alias("value"))
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .format("text")
        .option("path", path)
        .start()
    )


def logged(df, name, folder, line):
    """Log the rows of a batch and hand the same rows on."""
    log_lines(df, name, folder, line)
    return df


def tee(name, folder, line, then):
    """For ``foreachBatch``: log every micro-batch, then pass it on unchanged to ``then``.

    The batch is computed once and kept for both; a replayed batch replaces its own lines.
    """

    def batch(rows, batch_id):
        path = _log_folder(rows.sparkSession, folder, name)
        kept = rows.persist()
        try:
            kept.select(line.alias("value")).write.mode("overwrite").text(f"{path}/batch={batch_id:012d}")
            then(kept, batch_id)
        finally:
            kept.unpersist()

    return batch


def key_line(template, key="key"):
    """A log line that names the key of a row."""
    return F.format_string(template, F.col(key).cast("string"))
