"""Allow and block rules on URLs, as a sort-merge range join.

A rule is a host, a path prefix and a verdict. Its canonical key is the host's labels in reverse order, each
followed by a dot, and then the path: ``example.org`` and ``/es/`` give ``org.example./es/``. The rule fits a
key exactly if its own key is a prefix of it, so it owns the interval of keys from its key up to its key
followed by a byte that no text has. Intervals nest or are apart. A page has one key per ancestor of its host,
since a rule's path applies on all subdomains.

Keys and interval ends are dealt into key ranges and swept in order within each range; the sweep carries the
stack of rules that are open. Ranges are cut at a bounded sample of the keys, so that they are of a size
whatever the hosts are; equal addresses are merged first, so a hot host or URL is no hot range.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spindlewatch.llm.common import lower_ascii

# Keys from which the cuts between ranges are chosen. It has no influence on results.
CUT_SAMPLE = 20_000

AFTER_ALL = b"\xff"


def address(url):
    """Host and path of a URL: (host, path), both empty for null or where ``://`` is missing."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def rule_table(spark, rules):
    """Rules given as (verdict, host, path) as a DataFrame."""
    if not rules:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("verdict", "host", "path")])
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _labels(host):
    return F.reverse(F.split(host, r"\."))


def _key(labels, path):
    return F.concat(F.array_join(labels, "."), F.lit("."), path)


def _bytes(key):
    return key.cast("binary")


def _stacks(rules):
    """(lo, hi, stack) of each rule; the stack has the rules around it and itself, the outermost first."""
    own = (
        rules.select("host", "path", "verdict")
        .where("host is not null and path is not null and verdict is not null")
        .groupBy(lower_ascii(F.col("host")).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            _key(_labels(F.col("host")), F.col("path")).alias("key"),
            F.struct(
                F.length(F.concat("host", "path")).alias("length"),
                F.length("host").alias("host_length"),
                F.concat("host", "path").alias("rule"),
                "verdict",
            ).alias("entry"),
        )
    )
    prefixes = own.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select(
        "key", F.expr("substring(key, 1, n)").alias("prefix")
    )
    around = own.select(F.col("key").alias("prefix"), F.struct(F.length("key").alias("n"), "entry").alias("item"))
    return (
        prefixes.join(around, "prefix")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .select(
            _bytes(F.col("key")).alias("lo"),
            F.concat(_bytes(F.col("key")), F.lit(bytearray(AFTER_ALL))).alias("hi"),
            F.transform("items", lambda x: x["entry"]).alias("stack"),
        )
    )


def _cuts(keys, ranges, sample):
    """Up to ``ranges - 1`` keys that cut all of them into ranges of about a size."""
    chosen = keys.select("key").orderBy(F.xxhash64("key"), "key").limit(sample).collect()
    ordered = sorted({bytes(r.key) for r in chosen})
    step = max(1.0, len(ordered) / ranges)
    return sorted({ordered[int(i * step)] for i in range(1, ranges) if int(i * step) < len(ordered)})


def _range_of(key, cuts):
    """How many of the sorted ``cuts`` are not above ``key``, by bisection."""
    if not cuts:
        return F.lit(0)
    every = F.array(*[F.lit(bytearray(c)) for c in cuts])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(every, at + step - 1) <= key, at + step).otherwise(at)
    )


def judge(pages, rules, url="url", default="allow", ranges=None, sample=CUT_SAMPLE):
    """``pages`` with host, path, rule and verdict of their URL; columns of those names are replaced.

    Of all rules that fit, the longest wins (characters of host and path, then of the host); ``rule`` is its
    host and path. A page that no rule fits has a null rule and the verdict ``default``. A null URL, and one
    without ``://``, has an empty host and path, and is judged like any other. Rules given twice count once;
    if they disagree, the verdict that sorts last does (block before allow). Without rules all pages have the
    default. Rows with equal URLs are judged alike, and none is lost.
    """
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = address(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    known = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    depth = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0

    labels = _labels(F.col("host"))
    levels = F.transform(
        F.slice(F.sequence(F.lit(1), F.size(labels)), 1, depth) if depth else F.array().cast("array<int>"),
        lambda n: _bytes(_key(F.slice(labels, F.lit(1), n), F.col("path"))),
    )
    keys = known.select("host", "path").distinct().select("host", "path", F.explode(levels).alias("key"))
    cuts = _cuts(keys, ranges, sample)

    stacks = _stacks(rules)
    entries = stacks.schema["stack"].dataType
    # A rule opens in every range that its interval reaches into, before all of the range's keys.
    opening = stacks.select(
        F.explode(F.sequence(_range_of(F.col("lo"), cuts), _range_of(F.col("hi"), cuts))).alias("range"),
        F.col("lo").alias("key"),
        "stack",
    )
    closing = stacks.select(
        _range_of(F.col("hi"), cuts).alias("range"),
        F.col("hi").alias("key"),
        F.slice("stack", F.lit(1), F.size("stack") - 1).alias("stack"),
    )
    events = (
        opening.unionByName(closing)
        .withColumns({"is_page": F.lit(False), "host": F.lit(""), "path": F.lit("")})
        .unionByName(
            keys.select(
                _range_of(F.col("key"), cuts).alias("range"),
                "key",
                F.lit(None).cast(entries).alias("stack"),
                F.lit(True).alias("is_page"),
                "host",
                "path",
            )
        )
    )
    in_order = Window.partitionBy("range").orderBy("key", "is_page").rowsBetween(Window.unboundedPreceding, 0)
    best = (
        events.withColumn("open", F.last("stack", ignorenulls=True).over(in_order))
        .where(F.col("is_page") & (F.size("open") > 0))
        .groupBy("host", "path")
        .agg(F.max(F.element_at("open", -1)).alias("best"))
    )
    return known.join(best, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in kept],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
