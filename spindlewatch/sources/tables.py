"""Stored tables: profiles by location, and the activities ledger."""

from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewatch import names, schemas


def path_exists(spark, path):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def make_folder(spark, path):
    """Create a folder if it is not there, and return its path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)
    return path


def write_note(spark, path, text, replace=True):
    """Write a small text file. One that is there already is replaced, or, if it may not be, FileExistsError is raised:
    of several writers at once one succeeds, on stores that create files exclusively."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        stream = fs.create(hadoop_path, replace)
    except Py4JJavaError as error:
        if not replace and fs.exists(hadoop_path):
            raise FileExistsError(path) from error
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish_note(spark, folder, name, text):
    """Write a small text file that is there as a whole or not at all; one that is there already stays."""
    path = f"{folder}/{name}"
    if path_exists(spark, path):
        return
    write_note(spark, f"{folder}/_{name}", text)
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (f"{folder}/_{name}", path))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(source, target) and not fs.exists(target):
        raise OSError(f"cannot write {path}")


def names_in(spark, path):
    """Names of what is in a folder, in order; none if it is not there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def remove(spark, path):
    """Remove a file or folder, if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def read_note(spark, path):
    """The text of a small file, or None if there is none."""
    if not path_exists(spark, path):
        return None
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_table(spark, path, schema):
    """A parquet table with its declared schema; without rows if it was never written."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


# What a look-up of one profile reads; about a million profiles.
ROW_GROUP_BYTES = 16 * 1024 * 1024

# The folder's name is the location behind a mark, since a folder cannot stand for an empty text.
_PLACE, _MARK = "place", "="


def write_profiles(profiles, path, row_group_bytes=ROW_GROUP_BYTES):
    """Write profiles partitioned by location, so that a selection reads only its own location.

    Rows are brought together by location and, by their measured size, spread again: a location with a third
    of the fleet is written by many tasks, and locations with few machines leave one file each. Every location
    is a folder, so this is for hundreds of locations rather than for a million.

    Rows are in the order of their serial numbers, with a Bloom filter for each row group: a look-up of one serial
    number reads the row groups that may have it, of about ``row_group_bytes`` each, which is one as a rule.
    """
    placed = profiles.withColumn(_PLACE, F.concat(F.lit(_MARK), "location")).drop("location")
    ordered = placed.hint("rebalance", _PLACE).sortWithinPartitions(_PLACE, "serialNum")
    options = {
        "parquet.bloom.filter.enabled#serialNum": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.block.size": str(row_group_bytes),
    }
    ordered.write.options(**options).partitionBy(_PLACE).parquet(path)


def read_profiles(spark, path):
    """Stored profiles; a condition on the location is one on folders."""
    fields = [f for f in schemas.MACHINE_PROFILE if f.name != "location"]
    stored = read_table(spark, path, T.StructType([*fields, T.StructField(_PLACE, T.StringType())]))
    located = stored.withColumn("location", F.substring(_PLACE, len(_MARK) + 1, 1 << 30))
    return located.select(*schemas.MACHINE_PROFILE.names)


def register_tables(spark, profiles=None, status=None, activities=None):
    """Give the tables their SQL names."""
    for name, df in ((names.PROFILES, profiles), (names.STATUS, status), (names.ACTIVITIES, activities)):
        if df is not None:
            df.createOrReplaceTempView(name)


def point_lookup(df, key, value):
    """The row of one key."""
    return df.where(F.col(key) == F.lit(value))


def key_set(df, key="serialNum"):
    """The keys of a table; they are unique already."""
    return df.select(key)


def read_activities(spark, path):
    return read_table(spark, path, schemas.ACTIVITY)


def activity_value(spark, path, key):
    """The newest value noted for ``key``, or None."""
    row = read_activities(spark, path).where(F.col("key") == key).agg(F.max_by("value", "loggedAt").alias("v")).first()
    return row.v


def note_activities(spark, path, values):
    """Append entries, given as a dict, to the activities ledger: all of them in one file, or none."""
    entries = F.create_map(*[F.lit(x) for entry in values.items() for x in entry])
    noted = spark.range(1, numPartitions=1).select(F.explode(entries), F.current_timestamp().alias("loggedAt"))
    noted.write.mode("append").parquet(path)
