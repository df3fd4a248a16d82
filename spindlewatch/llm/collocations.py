"""Collocations: phrases of two or three words that occur together more often than their parts would by chance.

Phrases are counted level by level, first words, then pairs, then triples, and a phrase is counted only if both its
parts that are one word shorter may be frequent. What may be frequent is told by a bitmap of a fixed size over
hashes: a bit that is set by accident costs work and changes no count.

Every task counts in tries of its own, one per language: a shallow trie over word numbers with hash tables as
leaves, each of which bursts into one per next word when it grows large. When the task holds too many phrases, the
largest subtrees are spilled whole, each as a sorted run; runs are shuffled by the first words of their phrases and
merged in the partition of that prefix.
"""

from functools import reduce
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindlewatch.llm.common import BREAK, LOWERED, Shared, ship, words_in, written

ship(__name__)

# The language of texts without one, and the bytes that separate pieces and words.
UNDETERMINED = "und"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

# In place of whatever ends a piece there is a ``BREAK``.
PREPARED = bytes(0xFF if b in PIECE_ENDS else 0x20 if b in WORD_ENDS else b for b in LOWERED)

# Word numbers have 21 bits, so three of them make a key. A task forgets its words when there are this many.
BITS = 21
MASK = (1 << BITS) - 1
WORDS = 1 << 20

BURST = 4096  # phrases in a leaf
HELD = 1_000_000  # phrases in all tries of a task; half of them stay when it spills
TOKENS = 1 << 20  # words that are brought into order before they enter a trie
PART = 1 << 20  # bytes of a long text that are split at a time
GATHERED = 4  # parts that are split and numbered together
FILTER_BITS = 1 << 26  # bits of a bitmap: 8 MiB

SALTS = 64


class Subtree:
    """Phrases that begin alike: a hash table of counts, or one subtree for each next word."""

    __slots__ = ("entries", "children", "shift", "size")

    def __init__(self, shift):
        self.entries, self.children, self.shift, self.size = {}, None, shift, 0

    def add(self, keys, counts):
        """Counts of phrases, given in the order of their keys."""
        before = self.size
        if self.children is None:
            entries, get = self.entries, self.entries.get
            if entries:
                for key, count in zip(keys, counts):
                    entries[key] = get(key, 0) + count
            else:
                entries.update(zip(keys, counts))
            self.size = len(entries)
            if self.size > BURST and self.shift > 0:
                self.burst()
        else:
            self.route(keys, counts)
        return self.size - before

    def burst(self):
        entries, self.entries, self.children, self.size = self.entries, None, {}, 0
        keys = sorted(entries)
        self.route(keys, [entries[k] for k in keys])

    def route(self, keys, counts):
        heads = np.array(keys, np.int64) >> self.shift
        bounds = [0, *(np.flatnonzero(heads[1:] != heads[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(bounds, bounds[1:]):
            if start < end:
                head = int(heads[start])
                child = self.children.get(head)
                if child is None:
                    child = self.children[head] = Subtree(self.shift - BITS)
                self.size += child.add(keys[start:end], counts[start:end])

    def collect(self, into):
        if self.children is None:
            into.append(self.entries)
        else:
            for child in self.children.values():
                child.collect(into)


class Words(dict):
    """Numbers of one language's words from 1 on, their texts and hashes; 0 for words that are not wanted."""

    def __init__(self, lang, wanted):
        super().__init__()
        self.seed, self.wanted = xxhash.xxh64_intdigest(lang), wanted
        self.texts, self.hashes = [b""], [0]
        self[BREAK] = 0

    def __missing__(self, word):
        self.learn([word])
        return self[word]

    def learn(self, words):
        """Numbers of words that have none yet, as an array."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(self.seed)), np.uint64, len(words))
        chosen = np.ones(len(words), bool) if self.wanted is None else is_set(self.wanted, digests)
        numbers = np.where(chosen, np.cumsum(chosen) + len(self.texts) - 1, 0)
        self.texts += compress(words, chosen.tolist())
        self.hashes += digests[chosen].tolist()
        self.update(zip(words, numbers.tolist()))
        return numbers

    def numbers(self, words):
        """Numbers of different words, as an array; those that are new are taken up together."""
        numbers = np.fromiter(map(self.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if new.size:
            numbers[new] = self.learn([words[i] for i in new.tolist()])
        return numbers


def is_set(bitmap, digests):
    """Which hashes have their bit set."""
    places = digests & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1


def chained(digests, following):
    """Hashes of phrases that are one word longer."""
    mixed = digests * np.uint64(0x9E3779B97F4A7C15) + following
    return mixed ^ (mixed >> np.uint64(29))


def parts_of(text):
    """A lower-cased text in parts, with spaces between words and a ``BREAK`` wherever a piece ends."""
    text = text.translate(PREPARED)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PART)
        end = len(text) if end < 0 else end
        yield text[start:end]
        start = end


class Counter:
    """Counts the phrases of ``length`` words in texts of one task, and gives away sorted runs."""

    def __init__(self, length, wanted, held=HELD, words=WORDS, tokens=TOKENS):
        self.length, self.wanted = length, wanted
        self.held, self.most_words, self.most_tokens = held, words, tokens
        self.langs, self.waiting = {}, 0
        # Texts that are not yet split, by language.
        self.unsplit, self.bytes = {}, 0

    def add(self, lang, text):
        """Count a text; yields what has to be spilled."""
        if lang not in self.langs:
            self.langs[lang] = [Words(lang.encode(), self.wanted), [], Subtree(BITS * (self.length - 1)), 0]
        for part in parts_of(text):
            self.unsplit.setdefault(lang, []).append(part)
            self.bytes += len(part)
            if self.bytes >= GATHERED * PART:
                yield from self.number_all()
        # Phrases do not go on from one text to the next.
        self.unsplit.setdefault(lang, []).append(BREAK)
        self.bytes += 1

    def number_all(self):
        """Split what is not yet, and number its words."""
        unsplit, self.unsplit, self.bytes = self.unsplit, {}, 0
        for lang, parts in unsplit.items():
            state = self.langs[lang]
            words = words_in(b"".join(parts)).dictionary_encode()
            state[1].append(state[0].numbers(words.dictionary.to_pylist())[words.indices.to_numpy()])
            self.waiting += len(words)
        if self.waiting >= self.most_tokens:
            yield from self.settle_all()

    def settle_all(self):
        """Bring the words seen into the tries, and keep those within their bounds."""
        for lang in self.langs:
            self.settle(lang)
        self.waiting = 0
        if sum(trie.size for _, _, trie, _ in self.langs.values()) > self.held:
            yield from self.spill(self.held // 2)
        for lang in sorted(self.langs, key=lambda lang: -len(self.langs[lang][0])):
            if sum(len(words) - 1 for words, *_ in self.langs.values()) <= self.most_words:
                break
            yield from self.drop(lang)

    def settle(self, lang):
        state = self.langs[lang]
        numbers = np.concatenate(state[1]) if state[1] else np.zeros(0, np.int64)
        # The last words begin phrases that may go on.
        state[1] = [numbers[max(0, len(numbers) - self.length + 1) :]]
        keys = self.keys(state[0], numbers)
        if self.length == 1:
            state[3] += len(keys)
        unique, counts = np.unique(keys, return_counts=True)
        state[2].add(unique.tolist(), counts.tolist())

    def keys(self, words, numbers):
        """Keys of all phrases in a row of word numbers, without those that cannot be frequent."""
        n = len(numbers) - self.length + 1
        if n <= 0:
            return numbers[:0]
        inside = reduce(np.logical_and, (numbers[i : n + i] > 0 for i in range(self.length)))
        if self.length > 2:
            hashes = np.array(words.hashes, np.uint64)[numbers]
            digests = hashes[: len(hashes) - self.length + 2]
            for i in range(1, self.length - 1):
                digests = chained(digests, hashes[i : len(digests) + i])
            frequent = is_set(self.wanted, digests)
            inside &= frequent[:n] & frequent[1 : n + 1]
        keys = numbers[:n]
        for i in range(1, self.length):
            keys = keys << BITS | numbers[i : n + i]
        return keys[inside]

    def spill(self, leave):
        """Runs of the largest subtrees, until no more than ``leave`` phrases are held."""
        found = []
        for lang, (_, _, trie, _) in self.langs.items():
            heads = trie.children if trie.children is not None else {None: trie}
            found += [(child.size, lang, head) for head, child in heads.items()]
        held = sum(size for size, _, _ in found)
        chosen = {}
        for size, lang, head in sorted(found, key=lambda f: -f[0]):
            if held <= leave:
                break
            chosen.setdefault(lang, []).append(head)
            held -= size
        for lang, heads in chosen.items():
            trie, entries = self.langs[lang][2], []
            for head in heads:
                if head is None:
                    trie.collect(entries)
                    self.langs[lang][2] = Subtree(BITS * (self.length - 1))
                else:
                    child = trie.children.pop(head)
                    trie.size -= child.size
                    child.collect(entries)
            yield from self.runs(lang, entries)

    def runs(self, lang, entries):
        """Sorted runs of phrases and counts."""
        n = sum(map(len, entries))
        keys = np.fromiter(chain.from_iterable(entries), np.int64, n)
        counts = np.fromiter(chain.from_iterable(e.values() for e in entries), np.int64, n)
        if not len(keys):
            return
        texts = pa.array(self.langs[lang][0].texts, pa.binary())
        ranks = np.empty(len(texts), np.int64)
        ranks[pc.array_sort_indices(texts).to_numpy()] = np.arange(len(texts))
        columns = [keys >> BITS * i & MASK for i in reversed(range(self.length))]
        # Ranks take no more bits than word numbers do.
        order = np.argsort(reduce(lambda key, c: key << BITS | ranks[c], columns, np.int64(0)))
        for start in range(0, len(order), 1 << 16):
            some = order[start : start + (1 << 16)]
            words = [texts.take(pa.array(c[some])) for c in columns]
            phrases = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary())) if len(words) > 1 else words[0]
            yield lang, phrases, pa.array(counts[some])

    def drop(self, lang):
        """Give away all that is held of a language, and forget its words."""
        state = self.langs[lang]
        entries = []
        state[2].collect(entries)
        yield from self.runs(lang, entries)
        words, old = Words(lang.encode(), state[0].wanted), state[0].texts
        state[0], state[2] = words, Subtree(BITS * (self.length - 1))
        # Words that begin a phrase which may go on get their new numbers.
        state[1] = [np.array([words[old[i]] if i else 0 for i in part.tolist()], np.int64) for part in state[1]]

    def finish(self):
        yield from self.number_all()
        yield from self.settle_all()
        yield from self.spill(0)
        for lang, (*_, words) in self.langs.items():
            if words:
                # The number of words stands at the empty phrase.
                yield lang, pa.array([b""], pa.binary()), pa.array([words])


def _runs(docs, text, lang, length, wanted):
    """(lang, phrase, n): sorted runs of every task, in which a phrase may stand several times."""
    source = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNDETERMINED)).alias("lang"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    ).where("text is not null")
    shared = None if wanted is None else Shared(docs.sparkSession, wanted)

    def batch_of(lang, phrases, counts):
        langs = pa.repeat(pa.scalar(lang), len(counts))
        return pa.RecordBatch.from_arrays([langs, phrases.cast(pa.string()), counts], names=["lang", "phrase", "n"])

    def run(batches):
        counter = Counter(length, None if shared is None else shared.value())
        for batch in batches:
            for one, words in zip(batch.column(0), batch.column(1)):
                for part in counter.add(one.as_py(), words.as_py()):
                    yield batch_of(*part)
        for part in counter.finish():
            yield batch_of(*part)

    return source.mapInArrow(run, "lang string, phrase string, n bigint")


def _merged(runs, length):
    """Counts of phrases over all runs, merged in the partition of their prefix: at most their first two words."""
    if length <= 2:
        return runs.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    dealt = runs.withColumn("prefix", F.substring_index("phrase", " ", 2)).repartition("lang", "prefix")
    return dealt.groupBy("lang", "prefix", "phrase").agg(F.sum("n").alias("n")).drop("prefix")


def _bitmap(counts, bits):
    """A bitmap of ``bits`` bits over the hashes of the phrases of ``counts``; as large for few as for many."""

    def run(batches):
        for batch in batches:
            digests = np.empty(batch.num_rows, np.uint64)
            for i, (lang, phrase) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                seed = xxhash.xxh64_intdigest(lang.encode())
                first, *rest = (np.array([xxhash.xxh64_intdigest(w, seed)], np.uint64) for w in phrase.encode().split(b" "))
                digests[i] = reduce(chained, rest, first)[0]
            places = (digests & np.uint64(bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places >> 6), pa.array(places & 63)], names=["at", "bit"])

    places = counts.select("lang", "phrase").mapInArrow(run, "at bigint, bit bigint")
    # 64 bits are one row.
    set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").cast("int"))
    rows = places.groupBy("at").agg(F.bit_or(set_bit).alias("set")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[rows.column("at").to_numpy()] = rows.column("set").to_numpy()
    return bitmap.view(np.uint8)


def phrase_counts(docs, text="text", lang="lang", least=10, longest=3, filter_bits=FILTER_BITS):
    """Exact counts of all phrases of up to ``longest`` words that occur ``least`` times or more in a language.

    One table per length, of (lang, phrase, n). The first has the number of all words of each language besides, at
    the empty phrase.
    """
    if longest not in (1, 2, 3):
        raise ValueError(f"phrases have up to 3 words, not {longest}")
    levels, wanted = [], None
    for length in range(1, longest + 1):
        counts = _merged(_runs(docs, text, lang, length, wanted), length)
        levels.append(written(counts.where((F.col("n") >= least) | (F.col("phrase") == "")), f"phrases-{length}"))
        if length < longest:
            # Words by themselves, too: one that is rare is in no phrase that is wanted.
            wanted = _bitmap(reduce(DataFrame.unionByName, levels).where("phrase <> ''"), filter_bits)
    return levels


def _joined(start, length):
    """A part of the phrase whose words are in the column ``words``."""
    return F.array_join(F.slice("words", start, length), " ")


def scored_phrases(levels, covered=50):
    """Candidates among the phrases of :func:`phrase_counts` with their score: (lang, phrase, a, l, r, n, score).

    ``covered``: a phrase inside a longer one goes if that one's count is so many hundredths of its own or more.
    """
    whole = reduce(DataFrame.unionByName, levels).where("phrase <> ''")
    totals = levels[0].where("phrase = ''").select("lang", "n")
    words = F.split("phrase", " ")
    phrases = whole.where(F.size(words) > 1).select("lang", "phrase", F.col("n").alias("a"), words.alias("words"))
    longer = phrases.where(F.size("words") > 2)
    rest = F.size("words") - 1
    parts = F.array(_joined(F.lit(1), rest), _joined(F.lit(2), rest))
    inside = longer.select("lang", "a", F.explode(parts).alias("phrase"))
    covers = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    free = F.coalesce(100 * F.col("most") < covered * F.col("a"), F.lit(True))
    left = phrases.join(covers, ["lang", "phrase"], "left").where(free)
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), rest))).select(
        "lang",
        "phrase",
        "a",
        "k",
        _joined(F.lit(1), F.col("k")).alias("left"),
        _joined(F.col("k") + 1, F.size("words") - F.col("k")).alias("right"),
    )
    cuts = cuts.join(whole.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(whole.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in "alr")
    # All within 38 digits; l and r are at least a, so the quotient is a million at most.
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), l * r)
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.join(totals, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs, text="text", lang="lang", least=10, longest=3, covered=50, top=2000):
    """The ``top`` collocations of each language: (lang, rank, phrase, a, l, r, n, score).

    A-Z are lower-cased, texts split at ``[.,;:!?]`` and line ends into pieces, and those at spaces and tabs into
    words. a, l and r are the counts of the phrase and of its parts at the cut with the lowest score
    floor(1000000 a a / (l r)), of equal scores the one that is first; n is the number of the language's words.
    Phrases that occur less than ``least`` times are no candidates, and those inside a longer one with at least
    ``covered`` hundredths of their count are left out. Ranks go by score, then count, both falling, then by the
    phrase in the order of its bytes.

    A null text has no words; a null language counts as ``und``. Texts of any length are split in parts, and rows
    that repeat count each time. Without a candidate there are no rows.
    """
    found = scored_phrases(phrase_counts(docs, text, lang, least, longest), covered)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of parts of a language first, so that no task has to order all its phrases.
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    ranked = salted
    for keys in (["lang", "salt"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
