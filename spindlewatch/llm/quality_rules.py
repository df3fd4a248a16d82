"""Quality rules: counts per text, and how much a text's n-grams look like trusted text.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two multinomials over the
buckets are counted, one over the trusted documents and one over the whole corpus. A document's verdict is the
mean, over its n-grams, of the logarithm of their ratio, held against a fixed threshold. Every step is a
DataFrame expression; texts are never shuffled, only bucket counts are, and the documents' bucket numbers where
trusted ids are too many to be copied to all tasks.
"""

from pyspark.sql import functions as F

from spindlewatch.llm.common import BROADCAST_IDS, SPACES, words_of, written

BUCKETS = 1 << 16
# Parts that rows of one id are dealt over when trusted ids are joined by shuffling.
SALTS = 16
PRIOR = 5.0
THRESHOLD = -0.16
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def _hashes(words):
    """One 64-bit hash per word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def _bucket(gram, buckets):
    return F.pmod(gram, F.lit(buckets)).cast("int")


def _joined(array, others, apart):
    """Hashes of the elements of ``array`` with those of ``others`` that stand ``apart`` places later."""
    n = F.least(F.size(array), F.greatest(F.size(others) - apart, F.lit(0)))
    return F.zip_with(F.slice(array, F.lit(1), n), F.slice(others, F.lit(1 + apart), n), lambda x, y: F.xxhash64(x, y))


def _some_equal(array):
    return F.size(F.array_distinct(array)) < F.size(array)


def _with_repeats(df):
    """Adds ``n_repeat_words``: words in windows that occur twice or more in the same text.

    Windows are compared by their 64-bit hash. They are made only where four of their five words stand twice, and
    sorted only where two are equal.
    """
    hashed = df.withColumn("fours", _joined(F.col("pairs"), F.col("pairs"), 2)).withColumn(
        "windows", F.when(_some_equal("fours"), _joined(F.col("fours"), F.col("hashes"), 4))
    )
    repeated = _some_equal("windows")
    located = F.when(
        repeated, F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
    )
    sorted_ = hashed.withColumn("located", located)
    # Both neighbours in the sorted order are looked at; at either end null stands for a hash that is not there.
    m = F.greatest(F.size("located") - 1, F.lit(0))
    no_one = F.array(F.lit(None).cast("struct<w:bigint,i:int>"))
    before = F.concat(no_one, F.slice("located", F.lit(1), m))
    after = F.concat(F.slice("located", F.lit(2), m), no_one)
    half = F.zip_with(
        "located",
        before,
        lambda x, b: F.struct(x["w"].alias("w"), x["i"].alias("i"), x["w"].eqNullSafe(b["w"]).alias("same")),
    )
    alike = F.zip_with(half, after, lambda x, a: F.when(x["same"] | x["w"].eqNullSafe(a["w"]), x["i"]))
    starts = F.sort_array(F.filter(alike, lambda i: i.isNotNull()))
    placed = sorted_.withColumn("starts", F.when(F.col("located").isNotNull(), starts))
    rest = F.greatest(F.size("starts") - 1, F.lit(0))
    new_words = F.zip_with(
        F.slice("starts", F.lit(2), rest),
        F.slice("starts", F.lit(1), rest),
        lambda i, b: F.least(i - b, F.lit(WINDOW)).cast("bigint"),
    )
    reach = F.aggregate(new_words, F.lit(0).cast("bigint"), lambda a, x: a + x) + WINDOW
    return placed.withColumn(
        "n_repeat_words", F.when(F.size("starts") > 0, reach).otherwise(F.lit(0)).cast("bigint")
    ).drop("fours", "windows", "located", "starts")


def hashed_words(docs, text="text", **columns):
    """Per row the ``columns`` named, the text, and the hashes of its words and of pairs of neighbouring words."""
    return (
        docs.select(*[c.alias(n) for n, c in columns.items()], F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumn("words", words_of(F.col("text")))
        .withColumn("hashes", _hashes(F.col("words")))
        .withColumn("pairs", _joined(F.col("hashes"), F.col("hashes"), 1))
    )


def text_counts(hashed):
    """Counts of each text of :func:`hashed_words`: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    A null text has no words, and all its counts are zero.
    """
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    df = (
        hashed.withColumn("lines", lines)
        .withColumn("n_words", F.size("hashes").cast("bigint"))
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("bigint"))
        .withColumn("n_symbols", (F.size(F.split("text", f"[{SYMBOLS}]")) - 1).cast("bigint"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"))
        .drop("text", "lines", "words")
    )
    return _with_repeats(df)


def bucket_weights(docs, trusted, text="text", id_column="doc_id", buckets=BUCKETS, copied=BROADCAST_IDS):
    """Log ratio of each bucket between trusted and all documents: one row (``weights``), an array by bucket.

    The corpus is scaled to the size of the trusted part, and each bucket of both has ``PRIOR`` added, so that a
    bucket that is rare in the corpus tells little. ``trusted`` has the ids of trusted documents in its one column,
    and every one of them is learnt from. Up to ``copied`` ids go to every task; more are joined with the documents'
    ids and bucket numbers. If no trusted document occurs, all weights are zero.
    """
    ids = written(trusted.toDF("doc_id").where("doc_id is not null").distinct(), "trusted")
    ids = ids.withColumn("is_trusted", F.lit(True))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    if ids.count() <= copied:
        # Ids meet before the texts are cut, so that no arrays go through the join.
        marked = hashed_words(rows.join(F.broadcast(ids), "doc_id", "left"), is_trusted=F.col("is_trusted"))
        grams = marked.select("is_trusted", F.explode(F.concat("hashes", "pairs")).alias("gram"))
        grams = grams.select("is_trusted", _bucket(F.col("gram"), buckets).alias("bucket"))
    else:
        found = hashed_words(rows, doc_id=F.col("doc_id")).select(
            "doc_id", F.transform(F.concat("hashes", "pairs"), lambda x: _bucket(x, buckets)).alias("found")
        )
        # Rows of one id, or of none, are not all in one task.
        salted = found.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        each = ids.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        marked = salted.join(each, ["doc_id", "salt"], "left")
        grams = marked.select("is_trusted", F.explode("found").alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count("is_trusted").alias("t"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("t", F.lit(0)).alias("t")
    )
    listed = full.agg(
        F.sum("n").alias("all_n"),
        F.sum("t").alias("all_t"),
        F.sort_array(F.collect_list(F.struct("bucket", "n", "t"))).alias("rows"),
    )
    share = F.col("all_t") / F.greatest(F.col("all_n"), F.lit(1))
    ratio = F.transform(
        "rows",
        lambda r: F.when(
            F.col("all_t") > 0, F.log(r["t"] + F.lit(PRIOR)) - F.log(r["n"] * share + F.lit(PRIOR))
        ).otherwise(F.lit(0.0)),
    )
    return listed.select(ratio.alias("weights"))


def judge_quality(docs, trusted, text="text", id_column="doc_id", buckets=BUCKETS, threshold=THRESHOLD, keep=None):
    """Counts, base rules and verdict of every document: (doc_id, row, the counts, base_failed, llr, kept).

    ``row`` is the row that was judged with the columns ``keep``, all if it is not given; with none there is no
    ``row``. The result is written once and read again: a filter on it would otherwise be merged with the long chain
    of projections behind it, each mention of a column writing out the whole chain. For the rows kept, and nothing
    else, there is :func:`good_rows`, which writes none.

    ``llr`` is the mean log ratio over the text's words and neighbouring pairs. A document is kept if the base
    rules pass it (ten words or more, at most a fifth of them in repeated windows) and its ``llr`` reaches
    ``threshold``. Texts without words, and null ones, fail the base rules; their ``llr`` is 0. Without trusted
    documents every ``llr`` is 0 and only the base rules decide. Rows with equal ids are judged one by one.
    """
    return written(_judged(docs, trusted, text, id_column, buckets, threshold, keep), "judged")


def good_rows(docs, trusted, text="text", id_column="doc_id", buckets=BUCKETS, threshold=THRESHOLD):
    """The rows of ``docs`` that :func:`judge_quality` keeps.

    They come out of a generator, as Spark takes no filter past one into the projections behind it.
    """
    judged = _judged(docs, trusted, text, id_column, buckets, threshold)
    each = judged.select(F.explode_outer(F.when(F.col("kept"), F.array("row"))).alias("row"))
    return each.where(F.col("row").isNotNull()).select("row.*")


def _judged(docs, trusted, text, id_column, buckets, threshold, keep=None):
    weights = bucket_weights(docs, trusted, text, id_column, buckets).scalar()
    kept = docs.columns if keep is None else keep
    whole = {"row": F.struct(*[F.col(f"`{c}`") for c in kept])} if kept else {}
    counted = text_counts(hashed_words(docs, text, doc_id=F.col(id_column), **whole))
    grams = F.when(F.col("n_words") > 0, 2 * F.col("n_words") - 1)
    total = F.aggregate(
        F.concat("hashes", "pairs"),
        F.lit(0.0),
        lambda a, x: a + F.get(F.col("_weights"), _bucket(x, buckets)),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        counted.withColumn("_weights", weights)
        .withColumn("base_failed", failed)
        .withColumn("llr", F.coalesce(total / grams, F.lit(0.0)))
        .select(
            "doc_id",
            *whole,
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "llr",
            (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"),
        )
    )
