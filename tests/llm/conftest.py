import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = "/root/testdata/sf0.001"

# Names that the operators use for columns of their own, all null here.
CLASHING = "ids decoded score n key low token node n_words leaks leak_items notices places words range row".split()

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def _edge_texts():
    long_words = [f"w{i * i % 977}x{i % 89}" for i in range(3000)]
    changed = [*long_words[:1500], "other", *long_words[1500:]]
    passage = " ".join(f"p{i}." if i % 9 == 8 else f"p{i}" for i in range(60))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t \n"),
        (4, "one"),
        (5, "One TWO"),
        (6, " ".join(long_words)),
        (7, " ".join(changed)),
        (8, "the same row twice, with ten words and a few more here."),
        (8, "the same row twice, with ten words and a few more here."),
        (9, "an id with two texts is told apart by the texts of its rows."),
        (9, " ".join(changed)),
        (None, "no id here but a text of more than ten words all the same, yes."),
        (None, None),
        (11, f"Before it. {passage} After it."),
        (12, f"Something else {passage}"),
        (13, f"{passage}\n{passage}"),
        (14, "Released under the MIT License.\nLicensed under CC BY-NC 4.0 and under the MITT Licence; GNU Genral Public License"),
        (15, "cc by nc cc by nc apache license version 2 cc BY nc"),
        (16, "a <|endoftext|> b\u00a0 c\u3000\u3000d  \n\n e'll 12345 \u00fc\u0308\U0001f600!!!'s " + "=" * 700),
        (17, "ab " * 40 + "\x00\x1c\x85 end"),
        (18, "repeat this line\n" * 30),
        (19, "DE!! \u00c8\u00c7\u00c9!! " * 25),
        (20, "\u0130stanbul \u00c9T\u00c9 \u0301 x"),
    ]


@pytest.fixture(scope="session")
def edge_rows():
    return [(i, t, "en" if t else None, None if i == 4 else "s", len(t) if t else None) for i, t in _edge_texts()]


@pytest.fixture(scope="session")
def all_rows(spark, edge_rows):
    """The edge cases, and the first documents of the small table under ids of their own."""
    some = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 45").orderBy("doc_id").collect()
    return [*edge_rows, *[(1000 + r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in some]]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashing=True):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
        return docs.withColumns({c: F.lit(None).cast("string") for c in CLASHING}) if clashing else docs

    return make


@pytest.fixture(scope="session")
def docs(make_docs, all_rows):
    return make_docs(all_rows).cache()


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def items(spark):
    rows = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    return [*rows, (900, None), (901, ""), (902, "w0x0 w1x1 w4x2"), (902, "w0x0 w1x1 w4x2"), (None, "told apart by the"), (903, "..")]


@pytest.fixture(scope="session")
def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.fixture(scope="session")
def trusted_ids(spark):
    good = spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1 and doc_id < 45").collect()
    return sorted({1000 + r.doc_id for r in good})
