"""Substring dedup: sentences inside passages that stand elsewhere before.

A sentence ends at a full stop, exclamation or question mark, or line end, and also after any word whose hash
says so: that cuts unpunctuated text at the same words wherever it stands. From every sentence on, the shortest
run of at least three sentences and twelve words is hashed. Equal runs are found by one aggregation over all
documents and a join on the hash, both of which Spark can split however often a run occurs. All sentences that
a run covers are removed, but where it stands first: in the document with the smallest id, at its first place.

A passage that holds no whole run, for want of sentence ends, is found by windows: where any stretch of
``STRETCH`` words has no run inside, ``WINDOW`` words are hashed from every word on that has the least hash in some
neighbourhood of ``NEAR`` words. That is decided by the words of the stretch alone, so copies share windows
wherever they are spliced. Repeated windows go word by word, but those that touch a sentence removed by a run.

A hash is a polynomial in the words' own hashes, modulo 2**64, twice over: by sums of its terms,
all runs and windows of a text are hashed at the same time.
"""

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewatch.llm.common import map_texts, ship, written

ship(__name__)

SENTENCES = 3
WORDS = 12
CUT_EVERY = 16

# Repeats of this many words are found for certain; a window and a neighbourhood at each side fit in.
STRETCH = 50
WINDOW = 25
NEAR = 8

ENDS = (b".", b"!", b"?")
WORD_AT = re.compile(rb"[^\x20\x09-\x0D]+").finditer
REMEMBERED = 300_000


# Odd numbers whose powers the words of a run are multiplied by, one for each half of its hash.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# Tells the hashes of windows from those of runs.
OF_WINDOWS = np.uint64(0x165667B19E3779F9)

HASH = pa.struct([("high", pa.int64()), ("low", pa.int32())])


def ends_sentence(word):
    """Whether a (lower-cased) word ends a sentence, by the word alone."""
    return word.rstrip(b"\"')]").endswith(ENDS) or crc32(word) % CUT_EVERY == 0


class Words(dict):
    """Numbers of words, and by number whether a word ends a sentence, its CRC, and its two hashes."""

    def __init__(self):
        super().__init__()
        self.new = []
        self.ends, self.crcs = np.zeros(1024, bool), np.zeros(1024, np.uint32)
        self.hashes = np.zeros((2, 1024), np.uint64)
        self.up = self.down = np.ones((2, 1), np.uint64)

    def __missing__(self, word):
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def numbers(self, words):
        """Numbers of the words of one text, good until the next one."""
        if len(self) > REMEMBERED:
            self.clear()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            self.learn()
        return numbers

    def learn(self):
        """Fill in what is known of the new words, all at the same time."""
        new, self.new = self.new, []
        here = slice(len(self) - len(new), len(self))
        while len(self.ends) < len(self):
            self.ends, self.crcs = np.tile(self.ends, 2), np.tile(self.crcs, 2)
            self.hashes = np.tile(self.hashes, 2)
        self.ends[here] = np.fromiter(map(ends_sentence, new), bool, len(new))
        self.crcs[here] = np.fromiter(map(crc32, new), np.uint32, len(new))
        self.hashes[:, here] = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, new)), np.uint64).reshape(-1, 2).T

    def powers(self, n):
        """At least ``n`` powers of each base, and of its inverse."""
        if self.up.shape[1] < n:
            for name, exponent in (("up", 1), ("down", -1)):
                steps = np.ones((2, 2 * n), np.uint64)
                steps[:, 1:] = [[pow(base, exponent, 1 << 64)] for base in BASES]
                setattr(self, name, np.cumprod(steps, axis=1, dtype=np.uint64))
        return self.up, self.down


class Text:
    """A text's sentences, runs and windows. ``bounds`` are the numbers of the sentences' first words, and the
    number of all words."""

    def __init__(self, text, known):
        words, lines = [], []
        for line in text.lower().split(b"\n"):
            here = line.split()
            if here:
                words += here
                lines.append(len(words) - 1)
        numbers = known.numbers(words)
        self.n = len(words)
        self.flags, self.crcs = known.ends[numbers], known.crcs[numbers]
        flags = self.flags.copy()
        flags[lines] = True
        self.bounds = np.append(0, np.flatnonzero(flags) + 1)
        up, self.down = known.powers(self.n + 1)
        self.sums = np.zeros((2, self.n + 1), np.uint64)
        np.cumsum(known.hashes[:, numbers] * up[:, : self.n], axis=1, out=self.sums[:, 1:])

    def hashes(self, first, stop, more=np.uint64(0)):
        """Hashes, as a number of 64 and one of 32 bits each, of the words from ``first`` up to ``stop``."""
        both = (self.sums[:, stop] - self.sums[:, first]) * self.down[:, first] + more
        # Of the second one the upper half, into which all bits of the words' hashes go.
        both[1] >>= np.uint64(32)
        high, low = both.view(np.int64)
        return np.stack([high, low - (1 << 31)])

    def runs(self):
        """First sentence, one past the last, and the hashes of the shortest long enough run from each sentence on,
        where there is one."""
        count = len(self.bounds) - 1
        first = np.arange(max(0, count - SENTENCES + 1))
        stop = np.maximum(first + SENTENCES, np.searchsorted(self.bounds, self.bounds[first] + WORDS))
        first, stop = first[stop <= count], stop[stop <= count]
        return first, stop, self.hashes(self.bounds[first], self.bounds[stop])

    def windows(self):
        """First words and hashes of the windows in stretches that hold no run, by the words alone."""
        n = self.n
        nothing = np.zeros(0, np.int64)
        if n < STRETCH:
            return nothing, np.zeros((2, 0), np.int64)
        cuts = np.append(np.flatnonzero(self.flags), n)
        before = np.concatenate(([0], np.cumsum(self.flags)))
        low, high = before[: n - STRETCH + 1], before[STRETCH:]
        sparse = (high - low <= SENTENCES) | (cuts[high - 1] - cuts[low] < WORDS)
        if not sparse.any():
            return nothing, np.zeros((2, 0), np.int64)
        # Which starts of windows lie in a sparse stretch.
        marks = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(sparse)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + STRETCH - WINDOW + 1, -1)
        inside = np.cumsum(marks[:n]) > 0
        least = np.lib.stride_tricks.sliding_window_view(self.crcs, NEAR).argmin(axis=1) + np.arange(n - NEAR + 1)
        chosen = np.zeros(n, bool)
        chosen[least] = True
        first = np.flatnonzero(chosen & inside)
        return first, self.hashes(first, first + WINDOW, OF_WINDOWS)


    def repeats_itself(self, hashes):
        """Whether a run or window may stand in the text twice."""
        return len(np.unique(hashes[0])) < hashes.shape[1]


def with_runs(docs, text="text", keep=None):
    """``docs`` with ``runs``, the different hashes of a text's runs and windows; ``n_sentences``; and ``itself``,
    whether one of the runs or windows may stand in the text twice."""

    def make():
        known = Words()

        def run(texts):
            lists, counts, twice = [], [], []
            for content in texts:
                hashes, sentences, itself = np.zeros((2, 0), np.int64), 0, False
                if content:
                    cut = Text(content, known)
                    hashes = np.concatenate([cut.runs()[2], cut.windows()[1]], axis=1)
                    sentences, itself = len(cut.bounds) - 1, cut.repeats_itself(hashes)
                    if itself:
                        hashes = np.unique(hashes, axis=1)
                lists.append(hashes)
                counts.append(sentences)
                twice.append(itself)
            offsets = np.cumsum([0, *(x.shape[1] for x in lists)]).astype(np.int32)
            high, low = np.concatenate(lists, axis=1)
            pairs = pa.StructArray.from_arrays([pa.array(high), pa.array(low.astype(np.int32))], fields=list(HASH))
            runs = pa.ListArray.from_arrays(pa.array(offsets), pairs)
            return [runs, pa.array(counts, pa.int64()), pa.array(twice, pa.bool_())]

        return run

    fields = [
        ("runs", pa.list_(HASH), "array<struct<high:bigint,low:int>>"),
        ("n_sentences", pa.int64(), "bigint"),
        ("itself", pa.bool_(), "boolean"),
    ]
    return map_texts(docs, text, fields, make, keep)


def covered(all_runs, known):
    """Sentences inside a known run, or inside a run that stands in the same text before."""
    out, seen = set(), set()
    for first, stop, high, low in all_runs:
        if (high, low) in known or (high, low) in seen:
            out.update(range(first, stop))
        seen.add((high, low))
    return out


def with_windows(bounds, gone, all_windows, known):
    """Bounds and numbers of the parts that go, and how many sentences these touch: the sentences in ``gone``, and
    the words of windows that are known, or stand in the same text before, and touch none of those sentences."""
    taken, seen = set(), set()
    for first, high, low in all_windows:
        if (high, low) in known or (high, low) in seen:
            taken.add(first)
        seen.add((high, low))
    if not taken:
        return bounds, gone, len(gone)
    removed = np.zeros(bounds[-1], bool)
    for i in gone:
        removed[bounds[i] : bounds[i + 1]] = True
    cut = removed.copy()
    for first in taken:
        if not removed[first : first + WINDOW].any():
            cut[first : first + WINDOW] = True
    touched = int((np.add.reduceat(cut, bounds[:-1], dtype=np.int64) > 0).sum())
    parts = [0, *(np.flatnonzero(cut[1:] != cut[:-1]) + 1).tolist(), len(cut)]
    return parts, {i for i, at in enumerate(parts[:-1]) if cut[at]}, touched


def without(text, bounds, gone):
    """A text without the given sentences, or parts, up to the word after each."""
    spans = [m.span() for m in WORD_AT(text)]
    starts = [spans[b][0] for b in bounds[:-1]] + [len(text)]
    out, at = [], 0
    for i in range(len(bounds) - 1):
        if i in gone:
            out.append(text[at : starts[i]])
            at = starts[i + 1]
    return b"".join([*out, text[at:]])


def remove_repeats(docs, text="text", id_column="doc_id"):
    """``docs`` with repeated sentences cut from the texts, and the counts n_sentences and n_removed.

    Null and empty texts stay as they are, with counts of zero. Texts too short for a run lose nothing. Rows
    with equal ids count as one document; a null id sorts before all others. A text may end up empty. A sentence
    of which only a window's words go counts as removed, too.
    """
    kept = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    # The rows go along as they are, whatever their columns are called.
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    found = written(with_runs(rows, keep=["doc_id"]), "runs")
    each = found.select("doc_id", F.explode("runs").alias("run")).select("doc_id", "run.high", "run.low")
    firsts = (
        each.groupBy("high", "low")
        .agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("with_id"))
        .where("n > 1")
        .select("high", "low", F.when(F.col("n") == F.col("with_id"), F.col("first")).alias("first"))
    )
    # Rows without an id are first wherever they hold a run, so that none has a repeat of another row's.
    repeats = (
        each.where("doc_id is not null")
        .join(firsts, ["high", "low"])
        .where(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("high", "low")).alias("known"))
    )
    # What the hashing has shown of a text is known by its id where no other row has it: without repeats of any
    # kind such a text stays, with this many sentences, and need not be cut again.
    shown = (
        found.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n"), F.first("n_sentences").alias("n_sentences"), F.max("itself").alias("itself"))
        .join(repeats, "doc_id", "left")
    )
    stays = (F.col("n") == 1) & ~F.col("itself") & F.col("known").isNull()
    rows = docs.select(row, F.col(id_column).alias("doc_id"))
    joined = rows.where("doc_id is not null").join(shown, "doc_id", "left")
    joined = joined.select("row", "known", F.when(stays, F.col("n_sentences")).alias("stays"))
    no_runs, not_shown = (F.lit(None).cast(joined.schema[c].dataType).alias(c) for c in ("known", "stays"))
    nameless = rows.where("doc_id is null").select("row", no_runs, not_shown)
    fields = [docs.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())])
    names = schema.names
    at = kept.index(text)

    def cleaned(content, known, words):
        """A text without its repeats, the number of its sentences, and of those that went."""
        cut = Text(content, words)
        (first, stop, of_runs), (starts, of_windows) = cut.runs(), cut.windows()
        if known is None and not cut.repeats_itself(np.concatenate([of_runs, of_windows], axis=1)):
            return content, len(cut.bounds) - 1, 0
        here = {(r["high"], r["low"]) for r in known or ()}
        bounds = cut.bounds.tolist()
        gone = covered(zip(first.tolist(), stop.tolist(), *of_runs.tolist()), here)
        parts, gone, touched = with_windows(bounds, gone, zip(starts.tolist(), *of_windows.tolist()), here)
        return without(content, parts, gone) if gone else content, len(bounds) - 1, touched

    def clean(batches):
        words = Words()
        for batch in batches:
            columns = [batch.column(0).field(i) for i in range(len(kept))]
            counts = pc.fill_null(batch.column(2), 0).to_numpy(zero_copy_only=False).copy()
            removed, changed = np.zeros(batch.num_rows, np.int64), {}
            open_ = np.flatnonzero(batch.column(2).is_null().to_numpy(zero_copy_only=False))
            texts = columns[at].take(pa.array(open_)).cast(pa.binary()).to_pylist()
            for i, content, known in zip(open_.tolist(), texts, batch.column(1).take(pa.array(open_))):
                if content:
                    rest, counts[i], removed[i] = cleaned(content, known.as_py(), words)
                    if rest is not content:
                        changed[i] = rest.decode()
            if changed:
                mask = np.zeros(batch.num_rows, bool)
                mask[list(changed)] = True
                new = pa.array(list(changed.values()), columns[at].type)
                columns[at] = pc.replace_with_mask(columns[at], pa.array(mask), new)
            arrays = [*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.unionByName(nameless).mapInArrow(clean, schema)
