"""Language identification, words first.

A language's words have their log frequency in it. A word that no language knows is scored by its longest
character n-grams that are known, and by shorter ones if none is. The tables are counted by Spark on a bounded
sample of each language's labelled rows and pruned to a bounded size, since every task gets them.
"""

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from spindlewatch.llm.common import Shared, map_texts, ship

ship(__name__)

# Bounds of the model: labelled rows of one language it is fitted on, and entries kept per language and table.
FIT_ROWS = 4_000
TABLE_ENTRIES = 20_000
NGRAMS = (5, 4, 3, 2, 1)
SMOOTHING = 0.5

REMEMBERED = 200_000
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")

UNDETERMINED = "und"


def words_in(text):
    """Words of letters, in lower case."""
    return WORD.findall(text.lower())


def ngrams_of(word, n):
    """Character n-grams of a word with a mark at either end; single characters without marks."""
    marked = word if n == 1 else f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _counted(sample, text, language):
    """Counts per language, table (0: words, n: n-grams) and entry, the most frequent of each table."""

    def count(batches):
        words, total = Counter(), Counter()
        for batch in batches:
            for content, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.update((lang, word) for word in words_in(content))
        for (lang, word), times in words.items():
            total[lang, 0, word] += times
            for n in NGRAMS:
                for gram in ngrams_of(word, n):
                    total[lang, n, gram] += times
        langs, sizes, entries = zip(*total) if total else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(entries, pa.string()), pa.array(list(total.values()), pa.int64())],
            names=["lang", "size", "entry", "n"],
        )

    rows = sample.select(F.col(text).alias("text"), F.col(language).alias("lang"))
    counted = rows.mapInArrow(count, "lang string, size int, entry string, n bigint")
    return counted.groupBy("lang", "size", "entry").agg(F.sum("n").alias("n"))


class Languages:
    """Log frequencies per language: one row per entry of any table, and the tables' rows by entry."""

    def __init__(self, counts):
        self.languages = sorted({lang for lang, _, _, _ in counts})
        column = {lang: i for i, lang in enumerate(self.languages)}
        tables = {}
        for lang, size, entry, n in counts:
            tables.setdefault(size, {}).setdefault(entry, {})[column[lang]] = n
        self.rows, parts, first = {}, [], 0
        for size, table in tables.items():
            values = np.zeros((len(table), len(self.languages)))
            entries = sorted(table)
            for i, entry in enumerate(entries):
                for j, n in table[entry].items():
                    values[i, j] = n
            totals = values.sum(axis=0) + SMOOTHING * len(entries)
            parts.append(np.log((values + SMOOTHING) / totals))
            self.rows[size] = {entry: first + i for i, entry in enumerate(entries)}
            first += len(entries)
        # The last row is for words of which nothing is known.
        self.values = np.concatenate([*parts, np.zeros((1, len(self.languages)))])

    def rows_of(self, word):
        """Rows that a word is scored by: its own, or those of its longest known n-grams."""
        row = self.rows.get(0, {}).get(word)
        if row is not None:
            return (row,)
        for size in NGRAMS:
            index = self.rows.get(size, {})
            rows = tuple([index[g] for g in ngrams_of(word, size) if g in index])
            if rows:
                return rows
        return (len(self.values) - 1,)


class KnownWords(dict):
    """Rows of words already seen."""

    def __init__(self, languages):
        super().__init__()
        self.languages = languages

    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        rows = self[word] = self.languages.rows_of(word)
        return rows


def fit(labelled, text="text", language="lang", order="doc_id", rows=FIT_ROWS, entries=TABLE_ENTRIES):
    """The model, from at most ``rows`` labelled rows of each language (those with the least hash of ``order``, whole
    texts; of a rarer language all rows) and with at most ``entries`` entries per language and table (the most
    frequent ones).

    Rows without text or language are not used; rows with one ``order`` are taken together, if the first is. Without
    any row there is no language, and every text is undetermined.
    """
    usable = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull())
    # In three steps, so that no task gets all rows of a language, whatever its share of them.
    ids = usable.select(F.col(language).alias("_lang"), F.col(order).alias("_order"))
    mixed = ids.withColumn("_hash", F.xxhash64("_order")).withColumn("_task", F.spark_partition_id())
    few = _least(_least(mixed, rows, "_lang", "_task").withColumn("_task", F.col("_task") % 64), rows, "_lang", "_task")
    some = _least(few, rows, "_lang").select("_lang", "_order").distinct()
    sample = usable.join(
        some, usable[order].eqNullSafe(F.col("_order")) & (usable[language] == F.col("_lang")), "left_semi"
    )
    counted = _counted(sample, text, language)
    ranked = _most_frequent(counted, entries)
    return Languages([(r.lang, r.size, r.entry, r.n) for r in ranked.collect()])


def _least(ids, rows, *groups):
    """The ``rows`` ids with the least hash in each group."""
    order = Window.partitionBy(*groups).orderBy("_hash", "_order")
    return ids.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= rows).drop("_rank")


def _most_frequent(counted, entries):
    """The ``entries`` most frequent entries per language and table, ties in the order of the entry."""
    best = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "entry")
    return counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= entries).drop("rank")


def predict(docs, model, text="text", keep=None):
    """``docs`` with ``lang_pred`` and ``score``; columns of those names are replaced.

    A text's score per language is the sum over its words; ``score`` is the share of the best language when
    the mean per word is turned into probabilities. A null text and one without a letter is ``und``, score 0.
    Equal scores go to the language that sorts first.
    """
    shared = Shared(docs.sparkSession, model)

    def make():
        languages = shared.value()
        names, known = languages.languages, KnownWords(languages)

        def one(content):
            if content is None:
                return UNDETERMINED, 0.0
            counts = Counter(words_in(content.decode()))
            if not counts or not names:
                return UNDETERMINED, 0.0
            rows = list(map(known.__getitem__, counts))
            sizes = np.fromiter(map(len, rows), int, len(rows))
            times = np.fromiter(counts.values(), float, len(counts))
            total = np.repeat(times / sizes, sizes) @ languages.values[list(chain.from_iterable(rows))]
            share = np.exp((total - total.max()) / times.sum())
            best = int(np.argmax(total))
            return names[best], float(share[best] / share.sum())

        def run(texts):
            answers = [one(t) for t in texts]
            return [pa.array([a for a, _ in answers], pa.string()), pa.array([s for _, s in answers], pa.float64())]

        return run

    fields = [("lang_pred", pa.string(), "string"), ("score", pa.float64(), "double")]
    return map_texts(docs, text, fields, make, keep)
