"""Byte-pair encoding and decoding with the vocabulary of a public tokenizer file.

A pair of neighbouring bytes that no token of the vocabulary holds inside is a certain cut: no merge ever
crosses it. Such a pair before white space is also a boundary of the vocabulary's splitting pattern, so a whole
text is cut there first. The fragments repeat: those of a batch of texts that are new are encoded together. They
are split by the pattern, cut at all certain cuts, and what is left is merged for all of them at the same time,
in numpy, one merge of each per round. A fragment's ids are looked up wherever it stands, and concatenated.
"""

import heapq
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from spindlewatch.llm.common import Shared, map_texts, ship

ship(__name__)

# Fixed value: the pattern by which texts are split before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Fragments a worker remembers for certain; of older ones it remembers those that it has met again since.
REMEMBERED = 300_000

# Pieces without a certain cut inside are merged together up to the last of these lengths, in rows of one width each.
WIDTHS = (2, 4, 8, 16, 32, 64)
NO_MERGE = (1 << 31) - 1
ASCII_SPACES = b" \t\n\x0b\x0c\r"


def byte_letters():
    """The character that stands for each byte in the file: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    others = [b for b in range(256) if b not in letters]
    letters.update({b: chr(256 + i) for i, b in enumerate(others)})
    return letters

# Kinds of bytes: runs of one kind, letters, digits or signs, are pieces. An apostrophe may begin an ending of its own.
OTHER, SPACE = 0, 4
KINDS = np.full(256, OTHER, np.uint8)
KINDS[0x21:0x7F] = 3
KINDS[0x30:0x3A] = 2
KINDS[0x41:0x5B] = KINDS[0x61:0x7B] = 1
KINDS[0x20], KINDS[0x27] = SPACE, OTHER


class BytePairs:
    """Encoder and decoder of a byte-level vocabulary, given as the JSON text of its file."""

    def __init__(self, content):
        file = json.loads(content)
        byte_of = {letter: b for b, letter in byte_letters().items()}
        vocabulary = {bytes(byte_of[c] for c in token): i for token, i in file["model"]["vocab"].items()}
        self.special = {t["content"].encode(): t["id"] for t in file["added_tokens"]}
        size = 1 + max(chain(vocabulary.values(), self.special.values()))
        self.tokens = [b""] * size
        for token, i in chain(vocabulary.items(), self.special.items()):
            self.tokens[i] = token
        self.single = [vocabulary.get(bytes([b]), 0) for b in range(256)]
        self.singles = np.array(self.single, np.int32)
        made, keys = [], []
        for merge in file["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            left, right = (bytes(byte_of[c] for c in part) for part in (left, right))
            keys.append(vocabulary[left] << 32 | vocabulary[right])
            made.append(vocabulary[left + right])
        self.merges = {key: rank for rank, key in enumerate(keys)}
        # What a merge makes, by rank; and the ranks by pair, in the order of the pairs, with one that no pair reaches.
        self.made = np.array(made, np.int32)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order, NO_MERGE).astype(np.int32)
        # The same for pairs of bytes, by which every piece begins.
        both = np.arange(256)
        self.first = self.ranks_of(*(self.singles[x] for x in np.meshgrid(both, both, indexing="ij")))
        inside = np.zeros((256, 256), bool)
        for token in vocabulary:
            both = np.frombuffer(token, np.uint8)
            inside[both[:-1], both[1:]] = True
        self.inside = inside
        # Cuts are before white space, but for the few bytes that some token has before white space.
        spaces = list(ASCII_SPACES)
        others = [b for b in range(256) if b not in spaces]
        glued = [b for b in others if inside[b, spaces].any()]
        plain = [b for b in others if b not in glued]
        gap, glue, rest = (b"[" + b"".join(b"\\x%02x" % b for b in some) + b"]" for some in (spaces, glued, plain))
        more = b"(?:" + glue + gap + b"*" + rest + b"*)" if glued else b"(?!)"
        self.cut = re.compile(gap + b"*(?:" + rest + b"+" + more + b"*|" + more + b"+)|" + gap + b"+").findall
        self.special_at = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")") if self.special else None
        self.pieces = regex.compile(PATTERN).findall
        self.recent, self.former = {}, {}

    def encode(self, text):
        """Ids of a whole UTF-8 text."""
        return np.frombuffer(self.encode_all([text])[0], np.int32).tolist()

    def encode_all(self, texts):
        """Ids of whole UTF-8 texts, each as the bytes of 32-bit numbers. The texts of special tokens are those tokens."""
        cut = [self.fragments_of(text) for text in texts]
        self.remember(set(chain.from_iterable(cut)))
        return [b"".join(map(self.recent.__getitem__, fragments)) for fragments in cut]

    def fragments_of(self, text):
        if self.special_at is not None and any(s in text for s in self.special):
            parts = self.special_at.split(text)
            return [f for part in parts for f in ([part] if part in self.special else self.cut(part))]
        return self.cut(text)

    def remember(self, wanted):
        """Have the ids of all these fragments in ``recent``."""
        absent = wanted - self.recent.keys()
        if self.recent and len(self.recent) + len(absent) > REMEMBERED:
            self.recent, self.former, absent = {}, self.recent, wanted
        new = []
        for fragment in absent:
            ids = self.former.get(fragment)
            if ids is not None:
                self.recent[fragment] = ids
            elif fragment in self.special:
                self.recent[fragment] = np.int32(self.special[fragment]).tobytes()
            else:
                new.append(fragment)
        if new:
            self.recent.update(zip(new, self.encode_fragments(new)))

    def encode_fragments(self, fragments):
        """Ids of fragments of text, each as bytes."""
        ids, sizes = self.encode_together(fragments)
        ends = (np.cumsum(sizes) * 4).tolist()
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def encode_together(self, fragments):
        """Ids of fragments of text in a row, and how many each has."""
        data = np.frombuffer(b"".join(fragments), np.uint8)
        sizes = np.fromiter(map(len, fragments), np.int64, len(fragments))
        starts = np.cumsum(sizes) - sizes
        kinds = KINDS[data]
        begins = np.ones(len(data), bool)
        np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
        # A space at the start goes with what stands behind it.
        spaced = kinds[starts] == SPACE
        begins[(starts + 1)[spaced & (sizes > 1)]] = False
        begins[starts] = True
        # Fragments with anything else are split by the pattern.
        other = (kinds == OTHER) | (kinds == SPACE)
        other[starts[spaced]] = False
        owners = np.zeros(len(fragments), bool)
        owners[np.searchsorted(starts, np.flatnonzero(other), "right") - 1] = True
        begins[np.repeat(owners, sizes)] = False
        places = []
        for i, at in zip(np.flatnonzero(owners).tolist(), starts[owners].tolist()):
            places.append(at)
            text = fragments[i].decode()
            # A word of Latin letters with a space before it is one piece.
            if max(text) >= "\u0250" or not text[text[0] == " " :].isalpha():
                for piece in self.pieces(text)[:-1]:
                    at += len(piece.encode())
                    places.append(at)
        begins[places] = True
        begins[1:] |= ~self.inside[data[:-1], data[1:]]
        ids = self.merge_all(data, np.flatnonzero(begins))
        # Where each fragment's ids end, once those that were merged away are left out.
        ends = np.cumsum(ids >= 0)[starts + sizes - 1]
        return ids[ids >= 0], np.diff(ends, prepend=0)

    def merge(self, data):
        """Merges within one piece, the first in rank first and of equals the leftmost."""
        ids = self.merge_all(np.frombuffer(data, np.uint8), np.zeros(1, np.int64))
        return ids[ids >= 0].tolist()

    def merge_all(self, data, starts):
        """Merges within each of the pieces of ``data``: an id, or -1, in the place of each byte."""
        lengths = np.diff(np.append(starts, len(data)))
        ids = self.singles[data]
        least = 1
        for width in WIDTHS:
            some = np.flatnonzero((lengths > least) & (lengths <= width))
            least = width
            if some.size:
                self.merge_rows(data, ids, starts[some], lengths[some], width)
        for i in np.flatnonzero(lengths > least).tolist():
            start, end = int(starts[i]), int(starts[i] + lengths[i])
            merged = self.merge_long(ids[start:end].tolist())
            ids[start:end] = -1
            ids[start : start + len(merged)] = merged
        return ids

    def ranks_of(self, left, right):
        """Ranks of the merges of pairs of ids."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], np.int32(NO_MERGE))

    def merge_rows(self, data, ids, starts, lengths, width):
        """Merges within pieces of at most ``width`` bytes: a row of ranks for each, one merge in every row per round."""
        n = len(starts)
        places = np.arange(width)
        # Where each row's bytes are; the last ones are repeated, and have no rank.
        where = starts[:, None] + np.minimum(places, lengths[:, None] - 1)
        values = data[where]
        ranks = np.full((n, width), NO_MERGE, np.int32)
        ranks[:, :-1] = np.where(places[:-1] < lengths[:, None] - 1, self.first[values[:, :-1], values[:, 1:]], NO_MERGE)
        after = np.tile((places + 1).astype(np.int8), n)
        before = np.tile((places - 1).astype(np.int8), n)
        flat = ranks.reshape(-1)
        rows = np.arange(n)
        while True:
            at = ranks[rows].argmin(axis=1)
            best = flat[rows * width + at]
            live = best != NO_MERGE
            rows, at, best = rows[live], at[live], best[live]
            if not rows.size:
                return
            base, origin = rows * width, starts[rows]
            here = base + at
            gone = after[here].astype(np.int64)
            behind = after[base + gone].astype(np.int64)
            ahead = before[here].astype(np.int64)
            new = self.made[best]
            ids[origin + at] = new
            ids[origin + gone] = -1
            after[here] = behind
            flat[here] = flat[base + gone] = NO_MERGE
            more = np.flatnonzero(behind < lengths[rows])
            before[(base + behind)[more]] = at[more]
            flat[here[more]] = self.ranks_of(new[more], ids[(origin + behind)[more]])
            more = np.flatnonzero(ahead >= 0)
            flat[(base + ahead)[more]] = self.ranks_of(ids[(origin + ahead)[more]], new[more])

    def merge_long(self, ids):
        """The same for one long piece: a heap of merges over a linked list."""
        get, n = self.merges.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, ids[i], ids[i + 1]) for i in range(n - 1) if (rank := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := get(ids[left] << 32 | ids[right])) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]

    def decode(self, ids):
        """The UTF-8 text of ids; bytes that are no text become U+FFFD, unknown ids nothing."""
        data = b"".join(map(self.tokens.__getitem__, ids))
        try:
            data.decode()
            return data
        except UnicodeDecodeError:
            return data.decode("utf-8", "replace").encode()


def read_vocabulary(path):
    with open(path, encoding="utf-8") as file:
        return file.read()


def _ids_array(coded):
    """A list array of ids, from each text's ids as bytes."""
    offsets = np.cumsum([0, *map(len, coded)]) // 4
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(coded), np.int32)))


def tokenize(docs, vocabulary, text="text", keep=None, decoded=True):
    """``docs`` with ``ids``, the token ids of the whole text, and ``decoded``, the text they stand for.

    ``vocabulary`` is the content of the tokenizer's file; it is of a fixed size and goes to every task. A null
    text counts as empty: no ids, and an empty text back. Columns named ``ids`` and ``decoded`` are replaced.
    """
    shared = Shared(docs.sparkSession, vocabulary)
    fields = [("ids", pa.list_(pa.int32()), "array<int>")]
    if decoded:
        fields.append(("decoded", pa.string(), "string"))

    def make():
        pairs = BytePairs(shared.value())

        def run(texts):
            coded = pairs.encode_all([t or b"" for t in texts])
            out = [_ids_array(coded)]
            if decoded:
                ids = (np.frombuffer(c, np.int32).tolist() for c in coded)
                out.append(pa.array(map(pairs.decode, ids), pa.binary()).cast(pa.string()))
            return out

        return run

    return map_texts(docs, text, fields, make, keep)
