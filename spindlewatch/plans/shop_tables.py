"""The star-schema test tables read as a machine shop.

``events`` is the telemetry: the user is the machine, ``value`` its temperature. ``customer`` and ``nation``
are the profiles: the nation is the location, the market segment the block. The oracles in
:mod:`spindlewatch.plans.queries` state the same readings in SQL.
"""

from pyspark.sql import functions as F

from spindlewatch.functions.labels import critical_limit
from spindlewatch.functions.times import to_epoch_ms, utc_timestamp
from spindlewatch.session import run_dir
from spindlewatch.sources.topics import stream_table

# Bounds a micro-batch, and with it the state that it touches.
FILES_PER_BATCH = 64


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _telemetry(events):
    return events.select(
        F.col("user_id").alias("serialNum"),
        F.col("ts").alias("timestamp"),
        F.floor("value").cast("smallint").alias("bitTemp"),
    )


def telemetry(spark, sf_dir):
    """Stored telemetry: (serialNum, timestamp without zone, bitTemp)."""
    return _telemetry(table(spark, sf_dir, "events"))


def _in_order(spark, events, files):
    """Path of a copy of the events in ``files`` files by ranges of time, whose age is in the order of their events."""
    path = run_dir(spark, "events")
    events.select("user_id", "ts", "value").repartitionByRange(files, "ts").write.parquet(path)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def parts():
        # Names begin with the number of the range.
        found = [(s.getPath().getName(), s) for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
        return [s for _, s in sorted(found, key=lambda x: int(x[0].split("-")[1]))]

    # Tasks end in any order; a file stream goes by the time of files, which some stores keep to the second.
    stored = parts()
    newest = max((s.getModificationTime() for s in stored), default=0)
    for i, status in enumerate(stored, 1):
        fs.setTimes(status.getPath(), newest - 1000 * (len(stored) - i), -1)
    times = [s.getModificationTime() for s in parts()]
    if any(a >= b for a, b in zip(times, times[1:])):
        raise RuntimeError(f"the store of {path} does not keep the times of files, by which a stream orders them")
    return path


def telemetry_stream(spark, sf_dir, files=FILES_PER_BATCH):
    """The same as a stream of at most ``files`` files a micro-batch.

    A window is closed by the newest event seen, and rows that come later are dropped. So a table of more files
    than one micro-batch takes is first rewritten in the order of time, whatever the order of its files.
    """
    path = f"{sf_dir}/events.parquet"
    events = table(spark, sf_dir, "events")
    count = len(events.inputFiles())
    if count > files:
        path = _in_order(spark, events, count)
    return _telemetry(stream_table(spark, path, maxFilesPerTrigger=files))


def limits(spark, sf_dir):
    """Limits of every machine, without the rest of its profile."""
    return (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("serialNum"),
            (F.lit(20) + F.lit(20) * (F.col("c_custkey") % 4)).cast("smallint").alias("warningTemp"),
        )
        .withColumn("criticalTemp", critical_limit(F.col("warningTemp")))
    )


def profiles(spark, sf_dir, customers=None):
    """The profile table, or the part of it that belongs to some of the customers."""
    customers = table(spark, sf_dir, "customer") if customers is None else customers
    nations = table(spark, sf_dir, "nation")
    warning = (F.lit(20) + F.lit(20) * (F.col("c_custkey") % 4)).cast("smallint")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.col("c_custkey").alias("serialNum"),
        F.col("n_name").alias("location"),
        F.col("c_mktsegment").alias("block"),
        (F.col("c_custkey") % 8 * 0.125).cast("float").alias("faultyOdds"),
        F.col("c_name").alias("manufacturer"),
        warning.alias("warningTemp"),
        critical_limit(warning).alias("criticalTemp"),
        (F.lit(8000) + F.lit(1000) * (F.col("c_custkey") % 5)).cast("int").alias("maxRPM"),
    )


def solvent_profiles(spark, sf_dir):
    """A profile table with gaps: customers in debt have none."""
    return profiles(spark, sf_dir, table(spark, sf_dir, "customer").where("c_acctbal >= 0"))


def messages(spark, sf_dir):
    """Telemetry as topic messages. Events of type ``error`` are cut off in the middle of the text."""
    events = table(spark, sf_dir, "events")
    time = utc_timestamp(F.col("ts"))
    text = F.concat(
        F.lit('{"serialNum":"'), F.col("user_id").cast("string"),
        F.lit('","eventTime":'), to_epoch_ms(time).cast("string"),
        F.lit(',"bitRPM":10000,"bitTemp":'), F.floor("value").cast("string"),
        F.lit(',"bitPositionX":0,"bitPositionY":0,"bitPositionZ":0}'),
    )
    broken = F.when(F.col("event_type") == "error", F.regexp_replace(text, ',"bitPositionX.*$', "")).otherwise(text)
    return events.select(F.col("user_id").cast("string").alias("key"), broken.alias("value"), time.alias("timestamp"))


def template_lines(rows, key, place, block):
    """Template lines made from a table, in all the ways a line can be right or wrong."""
    number = F.concat(F.lit("."), (F.col(key) % 10).cast("string"))
    good = F.concat_ws(",", place, block, number)
    kind = F.col(key) % 9
    line = (
        F.when(kind == 0, F.concat_ws(",", place, block))
        .when(kind == 1, F.concat(good, F.lit(",x")))
        .when(kind == 2, F.concat_ws(",", place, block, F.lit("abc")))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.concat(good, F.lit(",,")))
        .when(kind == 5, F.concat_ws(",", place, block, F.concat(F.lit(" "), number)))
        .when(kind == 6, F.concat_ws(",", place, block, F.lit("")))
        .otherwise(good)
    )
    return rows.select(line.alias("value"), F.col(key).alias("line"))
