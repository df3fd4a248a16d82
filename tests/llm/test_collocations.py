"""Collocation mining against a plain count of everything."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import LOWER

from spindlewatch.llm import collocations as module
from spindlewatch.llm.collocations import collocations


def plain(rows, least=10, covered=50, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    many = {g: a for g, a in counts.items() if len(g) > 2 and a >= least}
    found = {}
    for (lang, *words), a in many.items():
        inside = [b for (x, *longer), b in many.items() if x == lang and len(longer) > len(words) and words in (longer[:2], longer[1:])]
        if any(100 * b >= covered * a for b in inside):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, some in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1)
    )


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "b", "é", "É", "x\x00", "w w", "\x1c", "long" * 30, *"cdefgh"]
    gaps = [" ", "  ", "\t", ", ", ".", "\n", "\x0b", "\r\n", " ; ", " ", " ", " "]
    rows = [(None, "en"), ("", "en"), (" .,\n", "fr"), ("solo", None)]
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "en", "fr", None, "und", ""])))
    return [*rows, *rows[:30]]


SCHEMA = "text string, lang string"


@pytest.mark.parametrize("top", [2000, 7])
def test_collocations(spark, monkeypatch, top):
    monkeypatch.setattr(module, "PART", 11)
    rows = random_rows(1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "'x' AS phrase", "1 AS n", "null AS prefix")
    assert sorted(map(tuple, collocations(frame, top=top).collect())) == plain(rows, top=top)


def test_collocations_do_not_depend_on_the_bitmap(spark, monkeypatch):
    """With 64 bits nearly every phrase passes; the counts are the same."""
    rows = random_rows(2)
    frame = spark.createDataFrame(rows, SCHEMA)
    levels = module.phrase_counts(frame, filter_bits=64)
    found = module.scored_phrases(levels).collect()
    assert sorted((r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found) == sorted((r[0], *r[2:]) for r in plain(rows))


def test_collocations_of_one_long_text(spark):
    rng = random.Random(3)
    text = " ".join(rng.choice("abcdefgh") * 2 for _ in range(300_000))
    rows = [(text, "en")]
    assert sorted(map(tuple, collocations(spark.createDataFrame(rows, SCHEMA)).collect())) == plain(rows)


def test_collocations_of_nothing(spark):
    for rows in ([], [(None, None)], [("too few words here", "en")]):
        assert collocations(spark.createDataFrame(rows, SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        collocations(spark.createDataFrame([], SCHEMA), longest=4)


def test_scores_beyond_64_bits(spark):
    """Counts of billions, whose squares by a million take more than 64 bits."""
    many = 3_000_000_000
    one = spark.createDataFrame([("en", "", 9 * many), ("en", "a", many + 7), ("en", "b", many + 9)], "lang string, phrase string, n bigint")
    two = spark.createDataFrame([("en", "a b", many)], "lang string, phrase string, n bigint")
    row = module.scored_phrases([one, two]).first()
    assert row.score == 1_000_000 * many * many // ((many + 7) * (many + 9))


@pytest.mark.parametrize("length", [1, 2, 3])
@pytest.mark.parametrize(("burst", "held", "words", "tokens"), [(4096, 10**6, 10**6, 10**6), (3, 20, 10**6, 16), (2, 10**6, 5, 8), (3, 12, 7, 3)])
def test_tries_burst_spill_and_forget(monkeypatch, length, burst, held, words, tokens):
    """Runs are in order and add up to the plain counts, however often a task bursts, spills and forgets words."""
    monkeypatch.setattr(module, "BURST", burst)
    monkeypatch.setattr(module, "PART", 5)
    everything = np.full(8, 255, np.uint8)
    counter = module.Counter(length, None if length == 1 else everything, held, words, tokens)
    expected, found, runs = Counter(), Counter(), []
    for text, lang in random_rows(4):
        lang, text = str(lang), text or ""
        for piece in re.split("[.,;:!?\n-\r]", text.translate(LOWER)):
            row = [w for w in re.split("[ \t]+", piece) if w]
            expected.update((lang, " ".join(row[i : i + length])) for i in range(len(row) - length + 1))
        runs += counter.add(lang, text.encode())
    runs += counter.finish()
    for lang, phrases, counts in runs:
        listed = phrases.to_pylist()
        assert [p.split(b" ") for p in listed] == sorted(p.split(b" ") for p in listed)
        for phrase, n in zip(listed, counts.to_pylist()):
            if phrase:
                found[lang, phrase.decode()] += n
    assert found == expected


def test_bitmap_keeps_every_frequent_phrase(spark):
    """Words and pairs of the table have their bit set, by the hash that counting uses."""
    rng = random.Random(6)
    pairs = {(rng.choice(["en", "und"]), f"w{rng.randrange(500)} é{rng.randrange(500)}") for _ in range(400)}
    frame = spark.createDataFrame(sorted(pairs), "lang string, phrase string")
    bitmap = module._bitmap(frame, 1 << 12)
    assert bitmap.nbytes * 8 == 1 << 12
    for lang, phrase in pairs:
        words = module.Words(lang.encode(), None)
        hashes = [np.array([words.hashes[words[w.encode()]]], np.uint64) for w in phrase.split(" ")]
        assert module.is_set(bitmap, module.chained(*hashes))[0]
    assert np.unpackbits(bitmap).sum() <= len(pairs)


def test_words_are_split_and_numbered_together(monkeypatch):
    """Words of all texts of a batch in order, pieces apart, each different word numbered in one go."""
    text = b" A b,,C\t\xc3\xa9. a\x00 \nb;b "
    expected = [b"a", b"b", b"\xff", b"\xff", b"c", b"\xc3\xa9", b"\xff", b"a\x00", b"\xff", b"b", b"\xff", b"b"]
    assert module.words_in(b"".join(module.parts_of(text))).to_pylist() == expected
    assert module.words_in(b"").to_pylist() == module.words_in(b"  ").to_pylist() == []
    asked = []

    class Noted(module.Words):
        def learn(self, words):
            asked.append(sorted(words))
            return super().learn(words)

    monkeypatch.setattr(module, "Words", Noted)
    counter = module.Counter(1, None)
    runs = [run for text in (b"one two one", b"Two three", b"one") for run in counter.add("en", text)] + [*counter.finish()]
    assert asked == [[b"one", b"three", b"two"]]
    assert {p: n for _, phrases, counts in runs for p, n in zip(phrases.to_pylist(), counts.to_pylist())} == {b"one": 3, b"two": 2, b"three": 1, b"": 6}


def test_words_that_are_rare_are_in_no_triple_that_is_counted():
    """A bitmap that has only one word's bit: other words get no number, whatever the length of phrases."""
    bitmap = np.zeros(8, np.uint8)
    place = module.xxhash.xxh64_intdigest(b"often", module.xxhash.xxh64_intdigest(b"en")) & 63
    bitmap[place >> 3] = 1 << (place & 7)
    for length in (2, 3):
        counter = module.Counter(length, bitmap)
        assert [*counter.add("en", b"often " * 3 + b"rare often")] == []
        [*counter.number_all()]
        words = counter.langs["en"][0]
        assert words[b"often"] == 1 and (words[b"rare"] == 0) == (module.xxhash.xxh64_intdigest(b"rare", words.seed) & 63 != place)
