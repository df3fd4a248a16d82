"""Quality classifier: histogram gradient-boosted trees over statistics of a text.

The trees are fitted with numpy on a bounded sample of labelled documents and kept as flat arrays of complete
trees, so that a batch of documents walks down all trees at once by indexing.
"""

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spindlewatch.llm.common import Shared, map_texts, ship

ship(__name__)

# Bound of the sample that the trees are fitted on.
FIT_ROWS = 20_000

TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
LEAST_WEIGHT = 2.0

# Kinds of bytes whose shares are statistics.
KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n", b".,;:", b"!?", b"#*$%&|<>", b"@/\\_=+~^`"]


def _kind_table():
    table = bytearray(256)
    for number, kind in enumerate(KINDS, 1):
        for b in kind:
            table[b] = number
    table[0x80:] = bytes([len(KINDS) + 1]) * 128
    return bytes(table)


KIND_OF = _kind_table()
N_STATISTICS = len(KINDS) + 13


def statistics(text):
    """Numbers that describe a UTF-8 text: all zero for a null or empty one."""
    if not text:
        return [0.0] * N_STATISTICS
    size = len(text)
    kinds = np.bincount(np.frombuffer(text.translate(KIND_OF), np.uint8), minlength=len(KINDS) + 2)
    words = text.split()
    n = len(words)
    out = [np.log1p(size), np.log1p(n), *(kinds[1:] / size)]
    if not n:
        return [float(x) for x in [*out, *[0.0] * (N_STATISTICS - len(out))]]
    counts = Counter(words)
    top = counts.most_common(1)[0][1]
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), float, n)
    out += [
        len(counts) / n,
        top / n,
        pairs / max(1, n - 1),
        sum(map(eq, words, words[1:])) / n,
        lengths.mean(),
        lengths.std(),
        lengths.max(),
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        sum(map(bytes.isupper, words)) / n,
    ]
    return [float(x) for x in out]


class Trees:
    """Complete trees in flat arrays: of every tree the features and limits of its inner nodes, and its leaves."""

    def __init__(self, start, features, limits, leaves):
        self.start = start
        self.features = features
        self.limits = limits
        self.leaves = leaves

    def score(self, x):
        """Probabilities of label 1 for the rows of ``x``."""
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.leaves))
        node = np.zeros((len(x), len(trees)), np.int64)
        inner = self.features.shape[1]
        while inner and len(x) and len(trees) and node[0, 0] < inner:
            right = x[rows, self.features[trees, node]] > self.limits[trees, node]
            node = 2 * node + 1 + right
        total = self.start + (self.leaves[trees, node - inner].sum(axis=1) if len(trees) else np.zeros(len(x)))
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(x, y, trees=TREES, depth=DEPTH, bins=BINS, rate=RATE):
    """Boosted trees for labels ``y`` (0 or 1). Without rows every score is a half."""
    good = float(y.sum())
    start = float(np.log((good + 1.0) / (len(y) - good + 1.0)))
    inner = 2**depth - 1
    n_features = x.shape[1]
    if not len(y) or good in (0.0, float(len(y))):
        empty = np.zeros((0, inner))
        return Trees(start, empty.astype(np.int64), empty, np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    codes = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    cell = codes + np.arange(n_features) * bins
    margin = np.full(len(y), start)
    features, limits, leaves = [], [], []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        slope, bend = p - y, p * (1.0 - p)
        node = np.zeros(len(y), np.int64)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            at = (node[:, None] * (n_features * bins) + cell).ravel()
            shape = (width, n_features, bins)
            size = width * n_features * bins
            left_s = np.bincount(at, np.repeat(slope, n_features), size).reshape(shape).cumsum(axis=2)
            left_b = np.bincount(at, np.repeat(bend, n_features), size).reshape(shape).cumsum(axis=2)
            all_s, all_b = left_s[:, :, -1:], left_b[:, :, -1:]
            right_s, right_b = all_s - left_s, all_b - left_b
            gain = left_s**2 / (left_b + RIDGE) + right_s**2 / (right_b + RIDGE) - all_s**2 / (all_b + RIDGE)
            gain[(left_b < LEAST_WEIGHT) | (right_b < LEAST_WEIGHT)] = 0.0
            best = gain.reshape(width, -1).argmax(axis=1)
            for i in range(width):
                f, code = divmod(int(best[i]), bins)
                if gain[i, f, code] > 1e-9 and code < len(cuts[f]):
                    feature[first + i], limit[first + i] = f, cuts[f][code]
            right = x[np.arange(len(y)), feature[first + node]] > limit[first + node]
            node = 2 * node + right
        value = -rate * np.bincount(node, slope, inner + 1) / (np.bincount(node, bend, inner + 1) + RIDGE)
        margin += value[node]
        features.append(feature)
        limits.append(limit)
        leaves.append(value)
    return Trees(start, np.array(features), np.array(limits), np.array(leaves))


def fit_quality(docs, labels, text="text", id_column="doc_id", rows=FIT_ROWS):
    """Trees fitted on at most ``rows`` labelled documents.

    ``labels`` has (doc_id, quality). Labels without an id or a quality are not used, and of several for one id
    the lowest counts. The sample is of the labels whose id has the least hash.
    """
    usable = labels.where("doc_id is not null and quality is not null")
    sample = (
        usable.groupBy("doc_id")
        .agg(F.min("quality").alias("_quality"))
        .withColumnRenamed("doc_id", "_id")
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    chosen = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")

    def make():
        return lambda texts: [pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))]

    fields = [("statistics", pa.list_(pa.float64()), "array<double>")]
    described = map_texts(chosen, "_text", fields, make, ["_id", "_quality"])
    # Ids may repeat among the documents; the bound holds all the same.
    found = described.orderBy(F.xxhash64("_id"), "_id", "statistics").limit(rows).collect()
    x = np.array([r.statistics for r in found]).reshape(len(found), N_STATISTICS)
    return fit_trees(x, np.array([1.0 if r["_quality"] > 0 else 0.0 for r in found]))


def score_quality(docs, trees, text="text", keep=None):
    """``docs`` with ``score``, the probability that a text is good; a column of that name is replaced.

    Null texts are scored as empty ones.
    """
    shared = Shared(docs.sparkSession, trees)

    def make():
        model = shared.value()

        def run(texts):
            x = np.array([statistics(t) for t in texts]).reshape(len(texts), N_STATISTICS)
            return [pa.array(model.score(x), pa.float64())]

        return run

    return map_texts(docs, text, [("score", pa.float64(), "double")], make, keep)
