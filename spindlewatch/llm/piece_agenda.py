"""SentencePiece encoding and decoding with the merge-type vocabulary of a public model file.

A text is a row of symbols, at first single characters. An agenda holds every pair of neighbouring symbols that
together are a piece, best score first and of equal scores the leftmost; the best pair becomes one symbol and its
new neighbours enter the agenda, until it is empty. What is then no piece is spelled in bytes.

Where no piece holds two neighbouring characters, no merge ever crosses, and the agenda works on either side alone.
Texts are taken apart at two such places, before a space that follows something else and between letters and
others; whether that holds is read from the vocabulary. The fragments repeat, and each is put through the agenda
once per task. All fragments that are new in an Arrow batch are encoded by the sentencepiece library as well, and a
text with one that differs is marked.
"""

import heapq
import re
from array import array
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import sentencepiece

from spindlewatch.llm.common import Shared, map_texts, ship

ship(__name__)

# The mark that stands for a space in pieces, and what an unknown id reads as.
SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "

LINE_END = "\n"

# Fragments that a worker remembers in each of two generations.
REMEMBERED = 400_000

# Symbols up to which the agenda is a list that is searched for its best entry; beyond it is a heap.
SHORT = 40
NOTHING = float("-inf")

# Characters of a long text that are taken apart at a time; it is divided at certain cuts only.
PART = 1 << 20


class Generations(dict):
    """Codes by fragment, made when first asked for. When full, those used since the last time stay."""

    def __init__(self, encode, size=REMEMBERED):
        super().__init__()
        self.encode, self.size, self.older, self.fresh = encode, size, {}, []

    def __missing__(self, fragment):
        code = self.older.get(fragment)
        if code is None:
            code = self.encode(fragment)
            self.fresh.append(fragment)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[fragment] = code
        return code


def _letter(char):
    return re.match(r"[^\W\d_]", char) is not None


class Pieces:
    """Encoder and decoder of a merge-type vocabulary, given as the bytes of its model file."""

    def __init__(self, content, remembered=REMEMBERED):
        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.library = model
        self.end = model.eos_id()
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.ids, self.scores, self.bytes = {}, {}, [0] * 256
        self.data, self.is_byte = [], np.zeros(len(names), bool)
        for i, name in enumerate(names):
            if model.is_byte(i):
                value = int(name[1:-1], 16)
                self.bytes[value], self.is_byte[i] = i, True
                self.data.append(bytes([value]))
            elif model.is_control(i):
                self.data.append(b"")
            elif model.is_unknown(i):
                self.data.append(UNKNOWN_TEXT.encode())
            else:
                self.ids[name], self.scores[name] = i, model.get_score(i)
                self.data.append(name.replace(SPACE, " ").encode())
        self.marked = {i for name, i in self.ids.items() if name.startswith(SPACE)}
        self.controls = {i for i in range(len(names)) if model.is_control(i)}
        self.fragments = self._cutter()
        self.known = Generations(self.encode_fragment, remembered)
        self.wrong = set()

    def _cutter(self):
        """A function from a text to its fragments, by the certain cuts that the vocabulary allows."""
        pairs = {pair for name in self.ids for pair in zip(name, name[1:])}
        if any(b == SPACE != a for a, b in pairs):
            return lambda text: [text] if text else []
        # Letters that some piece has next to something else count as others.
        glued = {c for a, b in pairs for c in (a, b) if SPACE not in (a, b) and _letter(a) != _letter(b) and _letter(c)}
        others = {b for a, b in pairs if (a in glued) != (b in glued) and SPACE not in (a, b) and _letter(b)} - glued
        if others or {a for a, b in pairs if b in glued and _letter(a)} - glued:
            return re.compile(" *[^ ]+| +").findall
        extra = "".join(map(re.escape, sorted(glued)))
        return re.compile(rf" *[^\W\d_{extra}]+| *(?:[^\w ]|[\d_{extra}])+| +").findall

    def encode(self, text):
        """Ids of a whole text as int32, with the end id. An empty text has the end id alone."""
        known = self.known.__getitem__
        code = [b"".join(map(known, part)) for part in self._parts(text)]
        return np.frombuffer(b"".join([*code, np.int32(self.end).tobytes()]), np.int32)

    def _parts(self, text):
        """The fragments of a text, for a part of it at a time."""
        if not text:
            return
        # A space is put before every text, and the mark itself reads as one.
        text = " " + text.replace(SPACE, " ")
        start = 0
        while start < len(text):
            cut = self._cut_after(text, start + PART)
            yield self.fragments(text[start:cut])
            start = cut

    def _cut_after(self, text, at):
        """The first place from ``at`` on where a space follows something else, or the end."""
        while at < len(text):
            at = text.find(" ", at)
            if at < 0:
                break
            if text[at - 1] != " ":
                return at
            at += 1
        return len(text)

    def encode_fragment(self, fragment):
        """The int32 bytes of a fragment's ids."""
        text = fragment.replace(" ", SPACE)
        symbols = self.merge(text) if len(text) <= SHORT else self.merge_long(text)
        try:
            return array("i", map(self.ids.__getitem__, symbols)).tobytes()
        except KeyError:
            spelled = ([self.ids[s]] if s in self.ids else map(self.bytes.__getitem__, s.encode()) for s in symbols)
            return array("i", chain.from_iterable(spelled)).tobytes()

    def merge(self, text):
        """Symbols left when the agenda of neighbouring pairs is empty."""
        score, symbols = self.scores.get, list(text)
        agenda = [score(pair, NOTHING) for pair in map(add, symbols, symbols[1:])]
        while agenda and (best := max(agenda)) != NOTHING:
            i = agenda.index(best)
            symbols[i] = piece = symbols[i] + symbols[i + 1]
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = score(piece + symbols[i + 1], NOTHING)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + piece, NOTHING)
        return symbols

    def merge_long(self, text):
        """The same for many symbols."""
        score, n = self.scores.get, len(text)
        symbols = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(-s, i, text[i : i + 2]) for i in range(n - 1) if (s := score(text[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            j = after[i]
            # A pair is out of date if either of its symbols has been merged since.
            if symbols[i] is None or j >= n or len(symbols[i]) + len(symbols[j]) != len(piece):
                continue
            symbols[i], symbols[j] = piece, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair = piece + symbols[k]
                if (s := score(pair)) is not None:
                    heapq.heappush(agenda, (-s, i, pair))
            k = before[i]
            if k >= 0:
                pair = symbols[k] + piece
                if (s := score(pair)) is not None:
                    heapq.heappush(agenda, (-s, k, pair))
        return [s for s in symbols if s is not None]

    def check_fresh(self):
        """Compares what was encoded since the last call with the library's ids, and returns all that ever differed."""
        fresh, self.known.fresh = self.known.fresh, []
        if fresh:
            # Nothing merges with a line end, so behind one a fragment is encoded as it is inside a text.
            found = self.library.encode([LINE_END + f for f in fresh], num_threads=1)
            skip = len(self.library.encode(LINE_END))
            for fragment, ids in zip(fresh, found):
                code = self.known.get(fragment) or self.encode_fragment(fragment)
                if np.array(ids[skip:], np.int32).tobytes() != code:
                    self.wrong.add(fragment)
        return self.wrong

    def agrees(self, text):
        """Whether the library gives the same ids for all fragments of a text that has been encoded."""
        wrong = self.check_fresh()
        return not wrong or wrong.isdisjoint(f for part in self._parts(text) for f in part)

    def decode(self, ids):
        """The UTF-8 text of ids: one space at the start goes, bytes that are no text become U+FFFD each."""
        listed = ids.tolist()
        data = b"".join(map(self.data.__getitem__, listed))
        first = next((i for i in listed if i not in self.controls), None)
        skip = 1 if first in self.marked else 0
        try:
            data.decode()
        except UnicodeDecodeError:
            return self._decode_runs(listed)[skip:]
        return data[skip:]

    def _decode_runs(self, ids):
        out, run = [], []
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run.append(self.data[i])
                continue
            if run:
                out.append(_spelled(b"".join(run)))
                run = []
            if i is not None:
                out.append(self.data[i])
        return b"".join(out)


def _spelled(data):
    """Bytes as UTF-8 text; every byte that is no part of a character becomes U+FFFD."""
    out = []
    while data:
        for n in range(1, 5):
            try:
                out.append(data[:n].decode().encode())
                break
            except UnicodeDecodeError:
                continue
        else:
            n = 1
            out.append("\ufffd".encode())
        data = data[n:]
    return b"".join(out)


def read_model(path):
    with open(path, "rb") as file:
        return file.read()


def _ids_array(lists):
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(ids) for ids in lists], out=offsets[1:])
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode_pieces(docs, model, text="text", keep=None):
    """``docs`` with ``ids``, the piece ids of the whole text and an end id, ``decoded``, the text they stand for, and
    ``agrees``: whether the sentencepiece library gives the same ids for each of the text's fragments.

    ``model`` is the content of the model file; it is of a fixed size and goes to every task. A null text counts
    as empty: the end id alone, and an empty text back. Rows are treated one by one, so equal rows have equal results.
    The text that comes back has spaces for the mark of a space (U+2581). Columns of these names are replaced.
    """
    shared = Shared(docs.sparkSession, model)
    fields = [
        ("ids", pa.list_(pa.int32()), "array<int>"),
        ("decoded", pa.string(), "string"),
        ("agrees", pa.bool_(), "boolean"),
    ]

    def make():
        pieces = Pieces(shared.value())

        def run(texts):
            texts = [t.decode() if t else "" for t in texts]
            ids = [pieces.encode(t) for t in texts]
            agree = [pieces.agrees(t) for t in texts]
            decoded = pa.array([pieces.decode(i) for i in ids], pa.binary()).cast(pa.string())
            return [_ids_array(ids), decoded, pa.array(agree)]

        return run

    return map_texts(docs, text, fields, make, keep)
