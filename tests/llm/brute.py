"""Plain versions of the operators, row by row in Python, for small tables."""

import re
import struct
from collections import Counter, defaultdict
from math import log
from zlib import crc32

import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced(text):
    return SPACED.findall(text or "")


def lettered(text):
    return LETTERS.findall((text or "").translate(LOWER))


def remainder(value, divisor):
    return crc32(("" if value is None else str(value)).encode()) % divisor


def covered_words(words, size=5):
    times = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    inside = set()
    for i in range(len(words) - size + 1):
        if times[tuple(words[i : i + size])] > 1:
            inside.update(range(i, i + size))
    return len(inside)


def text_counts(text):
    words = spaced(text)
    lines = [line for line in (text or "").split("\n") if SPACED.search(line)]
    symbols = sum((text or "").count(s) for s in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), covered_words(words)


def hash64(data, seed):
    return xxhash.xxh64_intdigest(data, seed)


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def grams(words):
    single = [signed(hash64(w.encode(), 42)) for w in words]
    packed = [struct.pack("<q", h) for h in single]
    return single + [signed(hash64(b, hash64(a, 42))) for a, b in zip(packed, packed[1:])]


def quality(rows, trusted, buckets, prior, threshold):
    """(base_failed, llr, kept) per row of (doc_id, text)."""
    all_n, all_t = Counter(), Counter()
    for doc_id, text in rows:
        found = [g % buckets for g in grams(spaced(text))]
        all_n.update(found)
        if doc_id in trusted:
            all_t.update(found)
    share = sum(all_t.values()) / max(1, sum(all_n.values()))
    out = []
    for _, text in rows:
        words = spaced(text)
        found = [g % buckets for g in grams(words)]
        llr = 0.0
        if found and all_t:
            llr = sum(log(all_t[g] + prior) - log(all_n[g] * share + prior) for g in found) / len(found)
        failed = len(words) < 10 or 100 * covered_words(words) > 20 * len(words)
        out.append((failed, llr, not failed and llr >= threshold))
    return out


def shingles(text, size):
    words = spaced((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(rows, size, percent):
    """(n_shingles, component_id) per row of (doc_id, text)."""
    sets = [shingles(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[top(i)] = top(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)].append(doc_id)
    return [
        (len(s), min(least[top(i)], default=None) if s else doc_id)
        for i, ((doc_id, _), s) in enumerate(zip(rows, sets))
    ]


def leaks(text, items, size=10):
    """Words of ``text`` inside windows of ``items`` (item_id, text), and the ids they are from."""
    words, hit, owners = lettered(text), set(), set()
    joined = f" {' '.join(words)} "
    for item_id, content in items:
        window = lettered(content)
        for i in range(max(1, len(window) - size + 1) if window else 0):
            part = window[i : i + size]
            if f" {' '.join(part)} " not in joined:
                continue
            for at in range(len(words) - len(part) + 1):
                if words[at : at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    if item_id is not None:
                        owners.add(str(item_id))
    return len(words), hit, owners


def without_words(text, hit):
    spans = [m.span() for m in LETTERS.finditer(text.translate(LOWER))]
    out, at, i = [], 0, 0
    while i < len(spans):
        if i in hit:
            j = i
            while j + 1 in hit:
                j += 1
            out.append(text[at : spans[i][0]])
            at = spans[j][1]
            i = j
        i += 1
    return "".join([*out, text[at:]])


def sentences(text, every):
    """Spans of words of the sentences of a text, and the words."""
    words, ends = [], []
    for line in (text or "").translate(LOWER).split("\n"):
        here = spaced(line)
        for i, word in enumerate(here):
            words.append(word)
            stop = word.rstrip("\"')]").endswith((".", "!", "?"))
            ends.append(stop or crc32(word.encode()) % every == 0 or i == len(here) - 1)
    out, start = [], 0
    for i, end in enumerate(ends):
        if end:
            out.append((start, i + 1))
            start = i + 1
    return words, out


def passages(rows, least_sentences, least_words, every):
    """(number of sentences, those removed, text) per row of (doc_id, text)."""
    cut, first = [], {}
    for doc_id, text in rows:
        words, spans = sentences(text, every)
        runs = []
        for i in range(len(spans)):
            j = i + least_sentences
            while j <= len(spans) and spans[j - 1][1] - spans[i][0] < least_words:
                j += 1
            if j <= len(spans):
                runs.append((i, j, tuple(words[spans[i][0] : spans[j - 1][1]])))
        cut.append((spans, runs))
        key = (doc_id is not None, doc_id)
        for _, _, run in runs:
            first[run] = min(first.get(run, key), key)
    out = []
    for (doc_id, text), (spans, runs) in zip(rows, cut):
        seen, gone = set(), set()
        for i, j, run in runs:
            if run in seen or first[run] != (doc_id is not None, doc_id):
                gone.update(range(i, j))
            seen.add(run)
        places = [m.span() for m in SPACED.finditer(text or "")]
        starts = [places[a][0] for a, _ in spans] + [len(text or "")]
        rest, at = [], 0
        for i in range(len(spans)):
            if i in gone:
                rest.append(text[at : starts[i]])
                at = starts[i + 1]
        out.append((len(spans), len(gone), "".join([*rest, text[at:]]) if gone else text))
    return out
