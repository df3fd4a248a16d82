"""Scoring of texts with a language model learnt from the corpus.

Spark counts the training words, and from them the subwords. Every text is then coded once, as the classes of its
subwords. Tasks train the attention model on all windows of their own training documents, and its parameters are
averaged after every round; scoring reads the same codes.

The base score needs the count of every word of a text. The most frequent words, a bounded number, go to every
task; the rest of a text's words is joined with the counts, which is the smaller part of the work and has no
hot key.
"""

from itertools import chain, repeat
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spindlewatch.llm.attention_model import CLASSES, STRIDE, Model
from spindlewatch.llm.byte_pairs import BytePairs
from spindlewatch.llm.common import BREAK, LOWERED, SPACES, Shared, map_texts, ship, slices, words_in, written

ship(__name__)

# Words whose counts every task gets; results do not depend on it.
HOT_WORDS = 100_000

# Rows whose words are counted at the same time, if their texts are not too long.
COUNTED = 8_192

# Words whose subwords are merged at the same time.
MERGED = 20_000

# Classes: one each for the most frequent subwords, and bins of equal weight for the others, those that start a
# word and those that do not apart; the last class is the end of a text.
BINS = 16
OWN_CLASSES = CLASSES - 2 * BINS - 1

# Training: the learning rate of each round. Every window is trained on once, in one of the rounds; a task shuffles
# this many windows at a time.
RATES = (0.02, 0.01, 0.004)
GATHERED = 49_152
STEP = 256

# By these, powers of two, a logarithm is divided into two whole numbers.
UNIT, PLACES = float(1 << 20), float(1 << 32)

# The words of a text that are counted by a join, with how often they are there.
RARE = pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())]))


# A-Z in lower case, and a space for whatever separates words.
SPACED = bytes(0x20 if b in SPACES.encode() else b for b in LOWERED)


def listed(words):
    """An Arrow array of words as a list; by way of numpy, since Arrow's own makes an object more for each."""
    return words.to_numpy(zero_copy_only=False).tolist()


def words_of_text(text):
    return text.translate(LOWERED).split() if text else []


def count_words(training, text="text"):
    """(word, c) over all whole training texts, added up for many texts at the same time first."""

    def count(batches):
        for batch in batches:
            for part in slices(batch, 0, COUNTED):
                content = b" ".join([t.translate(SPACED) for t in part.column(0).to_pylist() if t])
                if content:
                    found = words_in(content).value_counts()
                    table = pa.table({"word": found.field("values"), "c": found.field("counts")})
                    yield from table.to_batches(20_000)

    counted = training.select(F.col(text).cast("binary")).mapInArrow(count, "word binary, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


class Subwords:
    """Ids of words' subwords, with the space before them; texts of special tokens are ordinary words here. The
    vocabulary is the content of the tokenizer's file, or a :class:`BytePairs`, which is there much sooner."""

    def __init__(self, vocabulary):
        self.pairs = BytePairs(vocabulary) if isinstance(vocabulary, str) else vocabulary

    def __call__(self, word):
        return self.many([word])[0].tolist()

    def many(self, words):
        """The words' ids in a row, and how many each has; the words are merged together."""
        found = [(np.zeros(0, np.int32), np.zeros(0, np.int64))]
        for at in range(0, len(words), MERGED):
            found.append(self.pairs.encode_together([b" " + w for w in words[at : at + MERGED]]))
        return tuple(map(np.concatenate, zip(*found)))


def count_subwords(words, shared):
    """(id, n) of all subwords of the counted words."""

    def count(batches):
        encode = Subwords(shared.value())
        total = np.zeros(len(encode.pairs.tokens), np.int64)
        for batch in batches:
            ids, sizes = encode.many(listed(batch.column(0)))
            np.add.at(total, ids, np.repeat(batch.column(1).to_numpy(), sizes))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["id", "n"])

    return words.select("word", "c").mapInArrow(count, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


class Classes:
    """Class and share of its class for every subword id, from counts of all of them with one added."""

    def __init__(self, tokens, counts, ends):
        n = len(tokens)
        weight = np.ones(n)
        for i, c in counts:
            weight[i] += c
        order = np.lexsort((np.arange(n), -weight))
        self.of = np.zeros(n, np.uint16)
        self.of[order[:OWN_CLASSES]] = np.arange(min(OWN_CLASSES, n))
        at = OWN_CLASSES
        starts = np.array([t.startswith(b" ") for t in tokens])
        rest = order[OWN_CLASSES:]
        for group in (rest[starts[rest]], rest[~starts[rest]]):
            upto = np.cumsum(weight[group])
            bins = np.minimum(BINS - 1, (upto - weight[group]) * BINS // upto[-1]) if len(group) else upto
            self.of[group] = at + bins.astype(np.uint16)
            at += BINS
        self.end = at
        total = np.bincount(self.of, weight, at + 1)
        self.logs = np.log10(weight / total[self.of])
        total[self.end] = ends + 1
        self.frequencies = np.maximum(total, 1e-3)


class Words(dict):
    """Numbers of words, and by number the class codes of their subwords, the log share of these classes, and
    the log frequency from ``logs``, nan for words that are not there. The empty word is the end of a text."""

    def __init__(self, vocabulary, classes, remembered=500_000, logs=None):
        super().__init__()
        self.encode, self.classes, self.remembered, self.known = Subwords(vocabulary), classes, remembered, logs or {}
        self.forget()

    def forget(self):
        self.clear()
        self[b""] = self[BREAK] = 0
        self.words = [b""]
        self.codes = np.array([self.classes.end], np.uint16)
        self.sizes, self.shares = np.ones(1, np.int64), np.zeros(1)
        self.logs = np.array([self.known.get(b"", np.nan)])

    def learn(self, words):
        """Take up words that are not known, all at the same time."""
        ids, sizes = self.encode.many(words)
        shares = np.bincount(np.repeat(np.arange(len(words)), sizes), self.classes.logs[ids], len(words))
        logs = np.fromiter(map(self.known.get, words, repeat(np.nan)), float, len(words))
        self.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        self.words += words
        self.codes = np.concatenate([self.codes, self.classes.of[ids]])
        self.sizes, self.shares = np.concatenate([self.sizes, sizes]), np.concatenate([self.shares, shares])
        self.logs = np.concatenate([self.logs, logs])

    def numbers(self, lists):
        """:meth:`numbers_in` of texts that are given as lists of words."""
        return self.numbers_in([b" ".join(words) for words in lists])

    def numbers_in(self, texts):
        """Numbers of the texts' words in a row, an end after each text, and where each text starts. A-Z are in
        lower case, and words between spaces. Numbers are good until the next call."""
        row = words_in(b"".join([text + BREAK for text in texts])).dictionary_encode()
        different = listed(row.dictionary)
        numbers = np.fromiter(map(self.get, different, repeat(-1)), np.int64, len(different))
        if len(self.words) + np.count_nonzero(numbers < 0) > self.remembered:
            self.forget()
            numbers = np.fromiter(map(self.get, different, repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(numbers < 0)
        if new.size:
            numbers[new] = np.arange(new.size) + len(self.words)
            self.learn([different[i] for i in new.tolist()])
        numbers = numbers[row.indices.to_numpy()]
        return numbers, np.append(0, np.flatnonzero(numbers == 0)[:-1] + 1)

    def coded_numbers(self, numbers, starts):
        """Codes of each text, and the log share of its classes, from :meth:`numbers`."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        begins = (np.cumsum(self.sizes) - self.sizes)[numbers]
        codes = self.codes[np.arange(sizes.sum()) + np.repeat(begins - ends + sizes, sizes)].tobytes()
        bounds = [*(2 * (ends - sizes)[starts]).tolist(), len(codes)]
        return [codes[a:b] for a, b in zip(bounds, bounds[1:])], np.add.reduceat(self.shares[numbers], starts)

    def rare(self, numbers, starts):
        """Words of each text whose log frequency is not known, each with how often it is there, as an Arrow array."""
        at = np.flatnonzero(np.isnan(self.logs[numbers]) & (numbers > 0))
        texts = np.searchsorted(starts, at, "right") - 1
        pairs, k = np.unique(texts << 32 | numbers[at], return_counts=True)
        words = pa.array([self.words[i] for i in (pairs & 0xFFFFFFFF).tolist()], pa.binary())
        offsets = np.searchsorted(pairs, np.arange(len(starts) + 1) << 32)
        entries = pa.StructArray.from_arrays([words, pa.array(k, pa.int64())], fields=list(RARE.value_type))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)

    def coded(self, lists):
        """Codes of each text, its end included, and the log share of its classes, from the texts' words."""
        if lists:
            yield from zip(*self.coded_numbers(*self.numbers(lists)))


def _gathered(batches, model):
    """The windows of whole texts, given as one row of class codes each, in arrays of a bounded number of rows."""
    found, n = [], 0
    for batch in batches:
        for content in batch.column(0).to_pylist():
            codes = np.frombuffer(content, np.uint16)
            if len(codes) > GATHERED * STRIDE:
                segments = model.segments(codes)
                yield from (segments[at : at + GATHERED] for at in range(0, len(segments), GATHERED))
                continue
            found.append(codes)
            n += -(-len(codes) // STRIDE)
            if n >= GATHERED:
                yield model.windows(found)[0]
                found, n = [], 0
    if found:
        yield model.windows(found)[0]


def train(training, model, shared, classes, text="text"):
    """The model after the rounds on the training texts, see :func:`learn_from`."""

    def make():
        known = Words(shared.value(), classes.value())
        return lambda texts: [pa.array([c for c, _ in known.coded([words_of_text(t) for t in texts])], pa.binary())]

    return learn_from(written(map_texts(training, text, [("codes", pa.binary(), "binary")], make, []), "codes"), model)


def learn_from(codes, model):
    """The model after the rounds; each task trains on its own windows, and parameters are averaged by them.

    Every token of every training text, its end included, is the target of one step in one of the rounds. ``codes``
    is a stored table of one column, the texts' class codes.
    """
    for turn, rate in enumerate(RATES):
        start = Shared(codes.sparkSession, model)

        def learn(batches, start=start, turn=turn, rate=rate):
            local, seen = start.value(), 0
            for segments in _gathered(batches, local):
                order = np.random.default_rng(len(segments)).permutation(len(segments))[turn :: len(RATES)]
                if len(order):
                    local = local.train(segments[order], rate, STEP)
                    seen += len(order)
            if seen:
                values = local.flat() * seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(values)), pa.int32()), pa.array(values), pa.array(np.full(len(values), seen), pa.int64())],
                    names=["at", "value", "seen"],
                )

        learnt = codes.mapInArrow(learn, "at int, value double, seen bigint")
        rows = learnt.groupBy("at").agg((F.sum("value") / F.sum("seen")).alias("value")).collect()
        if rows:
            model = model.with_flat(np.array([r.value for r in sorted(rows)]))
    return model


def score_texts(docs, held_out, vocabulary, text="text", id_column="doc_id"):
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    ``held_out`` is a condition on the rows; all others are learnt from. Tokens are the words (A-Z as a-z) and
    one end per text. ``base_score`` adds up, with one added to counts, how frequent the tokens are; ``score``
    is the attention model's log10 probability of the words' subwords and the end. A null text counts as empty,
    so its only token is the end. Without training rows nothing is known, and the model is the untrained one.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_column).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    training = named.where(~F.col("held_out"))
    words = written(count_words(training), "words")
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = training.count()
    total, different = sums.n + ends, sums.v + (1 if ends else 0)
    base = total + different + 1
    pairs = BytePairs(vocabulary)
    shared = Shared(spark, pairs)
    kinds = Classes(pairs.tokens, [(r.id, r.n) for r in count_subwords(words, shared).collect()], ends)
    classes = Shared(spark, kinds)
    hot = words.orderBy(F.desc("c"), "word").limit(HOT_WORDS).collect()
    logs = {bytes(r.word): log10((r.c + 1) / base) for r in hot}
    logs[b""] = log10((ends + 1) / base)
    hot = Shared(spark, logs)

    fields = [
        ("n_tokens", pa.int64(), "bigint"),
        ("hot_known", pa.int64(), "bigint"),
        ("hot_score", pa.float64(), "double"),
        ("share", pa.float64(), "double"),
        ("codes", pa.binary(), "binary"),
        ("rare", RARE, "array<struct<word:binary,k:bigint>>"),
    ]

    def make():
        known = Words(shared.value(), classes.value(), logs=hot.value())

        def run(texts):
            numbers, starts = known.numbers_in([(t or b"").translate(SPACED) for t in texts])
            codes, shares = known.coded_numbers(numbers, starts)
            logs = known.logs[numbers]
            hits = (~np.isnan(logs)).astype(np.int64)
            if not ends:
                hits[numbers == 0] = 0
            return [
                pa.array(np.diff(np.append(starts, len(numbers)))),
                pa.array(np.add.reduceat(hits, starts)),
                pa.array(np.add.reduceat(np.nan_to_num(logs), starts)),
                pa.array(shares),
                pa.array(codes, pa.binary()),
                known.rare(numbers, starts),
            ]

        return run

    coded = map_texts(named, "text", fields, make, ["doc_id", "held_out"])
    coded = written(coded.withColumn("row", F.monotonically_increasing_id()), "coded")
    model = learn_from(coded.where(~F.col("held_out")).select("codes"), Model.new(kinds.frequencies))
    learnt = Shared(spark, model)

    def make_scores():
        trained = learnt.value()

        def run(codes):
            windows, counts = trained.windows([np.frombuffer(c, np.uint16) for c in codes])
            return [pa.array(np.add.reduceat(trained.log10(windows), np.cumsum(counts) - counts))]

        return run

    kept = ["row", "doc_id", "held_out", "n_tokens", "hot_known", "hot_score", "share"]
    scored = map_texts(coded, "codes", [("score", pa.float64(), "double")], make_scores, kept)
    rare = coded.select("row", F.inline("rare"))
    joined = rare.join(words, "word", "left").select("row", "k", F.coalesce("c", F.lit(0)).alias("c"))
    # A logarithm's 52 binary places as two whole numbers: sums of these do not depend on how rows were dealt.
    scaled = F.log10((F.col("c") + 1) / F.lit(base).cast("double")) * UNIT
    joined = joined.select("row", "k", F.when(F.col("c") > 0, F.col("k")).otherwise(0).alias("known"), scaled.alias("log"))
    whole, places = F.floor("log"), F.floor((F.col("log") - F.floor("log")) * PLACES)
    sums = [F.sum(whole * F.col("k")).alias("whole"), F.sum(places * F.col("k")).alias("places")]
    rest = joined.groupBy("row").agg(F.sum("known").alias("rest_known"), *sums)
    rest_score = F.col("whole") / UNIT + F.col("places") / (UNIT * PLACES)
    rest = rest.select("row", "rest_known", rest_score.alias("rest_score"))
    return scored.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("hot_score") + F.coalesce("rest_score", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.col("share")).alias("score"),
    )
