"""A pipeline over a corpus: rules on quality, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the docs of
the next one. All but the last return the columns of documents. A row is told by its doc_id: rows without one
pass the stage that looks for near duplicates as they are.
"""

from pyspark.sql import functions as F

from spindlewatch.llm.byte_pairs import read_vocabulary, tokenize
from spindlewatch.llm.common import copied, distilled, sized, table, written
from spindlewatch.llm.decontaminate import without_leaks
from spindlewatch.llm.passages import remove_repeats
from spindlewatch.llm.quality_rules import good_rows
from spindlewatch.llm.queries import VOCABULARY, good_ids
from spindlewatch.llm.shingle_join import similar_components


def _counted(docs):
    """``docs`` with ``n_chars``, where there is one, as the length of the present text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules on quality keep."""
    return good_rows(docs, good_ids(spark, sf_dir)).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """Of each group of near duplicates (five words, four fifths) the document with the smallest id.

    Of several equal rows one stays; rows with one id and different texts stay or go together, as the one that
    is first in its group.
    """

    def later():
        linked = similar_components(docs, size=5, percent=80).where("doc_id is not null")
        first = linked.groupBy("doc_id").agg(F.min("component_id").alias("first"))
        return first.where("first < doc_id").select("doc_id")

    # Only these ids are needed of all that the join writes, which is more than the documents themselves.
    gone = copied(distilled(spark, "gone", later))
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    twice = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if twice.isEmpty():
        return kept
    twice = sized(twice.select("doc_id"))
    several = kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(twice, "doc_id", "left_anti").unionByName(several).select(*docs.columns)


def repeated_passages(spark, docs, sf_dir):
    """Documents without sentences in passages that stand elsewhere before; those left without words go."""
    cleaned = remove_repeats(docs)
    some = F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) > 0
    return _counted(cleaned.where((F.col("n_removed") == 0) | some).select(*docs.columns))


def benchmark_leaks(spark, docs, sf_dir):
    """Documents without the words that repeat a window of a benchmark item."""
    return _counted(without_leaks(docs, table(spark, sf_dir, "benchmark")))


def tokens(spark, docs, sf_dir):
    """Token ids of every text, and whether they decode to that text."""
    coded = tokenize(docs, read_vocabulary(VOCABULARY))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", same.alias("decodes"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("tokens", tokens),
]

# The stages hash, link and encode in ways that SQL cannot state; the tests hold the result against a
# brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, one after the other, on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
