"""Benchmark decontamination: documents' words that repeat a run of words of a benchmark item.

A window is ten consecutive words of an item, or all of a shorter one. Windows go to every task as a hash set,
in blocks of a bounded number of windows; each block is one pass over the documents, without a shuffle. In a
document only stretches of words that all occur in the block are looked up, by the words' numbers, so a hit is
an equality of words and not of hashes.
"""

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from spindlewatch.llm.common import WORDY, Shared, list_array, map_texts, ship, slices

ship(__name__)

WINDOW = 10
BLOCK_WINDOWS = 200_000

SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def words_of_text(text):
    """Lower-cased words of a UTF-8 text: letters, digits and everything beyond ASCII."""
    return [] if text is None else text.translate(WORDY).split()


class Block:
    """Windows of items: numbers for their words, and per length the windows with the items they are from."""

    def __init__(self):
        self.numbers = {}
        self.windows = {}
        self.size = 0

    def add(self, words, item):
        numbers = self.numbers
        key = array("i", [numbers.setdefault(w, len(numbers) + 1) for w in words]).tobytes()
        self.windows.setdefault(len(words), {}).setdefault(key, set()).add(item)
        self.size += 1

    def hits(self, words):
        """Starts and lengths of the windows that occur in ``words``, and the items they are from."""
        ids = np.fromiter(map(self.numbers.get, words, [0] * len(words)), np.int32, len(words))
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        found, items = [], set()
        for length, windows in self.windows.items():
            if length > len(words):
                continue
            for at in np.flatnonzero(known[length:] - known[:-length] == length).tolist():
                owners = windows.get(ids[at : at + length].tobytes())
                if owners is not None:
                    found.append((at, at + length))
                    items |= owners
        return found, items


def item_blocks(benchmark, item_id="item_id", text="text", window=WINDOW, block_windows=BLOCK_WINDOWS):
    """The benchmark's windows in blocks; items are streamed, so no more than a block is held at once."""
    block = Block()
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text"))
    for item, content in items.toLocalIterator():
        words = words_of_text(content)
        for at in range(max(1, len(words) - window + 1) if words else 0):
            block.add(words[at : at + window], item)
            if block.size >= block_windows:
                yield block
                block = Block()
    if block.size:
        yield block


def merged(spans):
    """Spans in order, those that touch or overlap as one."""
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


FIELDS = [
    ("n_words", pa.int64(), "bigint"),
    ("leaks", pa.list_(SPAN), "array<struct<start:int,end:int>>"),
    ("leak_items", pa.list_(pa.string()), "array<string>"),
]


def _scan(docs, shared, text, first, keep):
    names = (("_leaks", "array<struct<start:int,end:int>>"), ("_leak_items", "array<string>"))
    before = docs if first else docs.withColumnsRenamed({"leaks": "_leaks", "leak_items": "_leak_items"})

    def make():
        block = shared.value() if shared else Block()

        def run(texts):
            counts, spans, items = [], [], []
            for content in texts:
                words = words_of_text(content)
                found, owners = block.hits(words)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged(found)])
                items.append(sorted(x for x in owners if x is not None))
            return [pa.array(counts, pa.int64()), list_array(spans, SPAN), list_array(items, pa.string())]

        return run

    kept = keep if first else [*keep, *[n for n, _ in names]]
    scanned = map_texts(before, text, FIELDS, make, kept)
    if first:
        return scanned
    return scanned.withColumns(
        {"leaks": F.concat("_leaks", "leaks"), "leak_items": F.array_union("_leak_items", "leak_items")}
    ).drop("_leaks", "_leak_items")


def find_leaks(docs, benchmark, text="text", item_text="text", item_id="item_id", keep=None, block_windows=BLOCK_WINDOWS):
    """``docs`` with n_words, ``leaks`` and ``leak_items``; columns of those names are replaced.

    ``leaks`` are the spans of words (from 0, end excluded) inside any occurrence of a window, and
    ``leak_items`` the ids, as texts, of all items with an occurring window. A null or empty text has no words
    and no leaks; an item without words has no window; items without an id leak but cannot be listed. Equal
    items count once each under their ids. An empty benchmark leaks nothing.
    """
    keep = list(docs.columns if keep is None else keep)
    if text not in keep:
        keep.append(text)
    keep = [c for c in keep if c not in ("n_words", "leaks", "leak_items")]
    out, first = docs, True
    for block in item_blocks(benchmark, item_id, item_text, block_windows=block_windows):
        out, first = _scan(out, Shared(docs.sparkSession, block), text, first, keep), False
    if first:
        return _scan(out, None, text, True, keep)
    return out


def n_hit(leaks):
    """Words inside any of the spans; spans of different blocks may overlap."""
    ordered = F.sort_array(leaks)
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto"))

    def step(done, span):
        begin = F.greatest(done["upto"], span["start"])
        return F.struct(
            (done["n"] + F.greatest(span["end"] - begin, F.lit(0))).cast("bigint").alias("n"),
            F.greatest(done["upto"], span["end"]).alias("upto"),
        )

    return F.aggregate(ordered, start, step, lambda done: done["n"])


def without_leaks(docs, benchmark, text="text", block_windows=BLOCK_WINDOWS):
    """``docs`` with the leaked words cut out of their texts, and without documents of which no word is left.

    A cut reaches from the first to the last leaked word; what stands between words outside of cuts is kept as
    it is. Documents without leaks are left alone, also those that have no words. The last block of windows is
    looked for where the cuts are made, so one block takes one worker per task, and texts go to it once.
    """
    blocks = [Shared(docs.sparkSession, b) for b in item_blocks(benchmark, block_windows=block_windows)]
    if not blocks:
        return docs
    # The other columns go along as they are, whatever they are called.
    names, others = docs.columns, [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)
    found = docs.select(F.col(f"`{text}`").alias("text"), row.alias("_row"))
    for i, shared in enumerate(blocks[:-1]):
        found = _scan(found, shared, "text", i == 0, ["_row", "text"])
    found = found.select("text", "_row", *(["leaks"] if len(blocks) > 1 else []))
    last = blocks[-1]

    def cut(batches):
        block = last.value()
        for batch in batches:
            for part in slices(batch, 0):
                contents = part.column(0).cast(pa.binary()).to_pylist()
                before = part.column(2).to_pylist() if part.num_columns > 2 else [[]] * len(contents)
                keep, changed = np.ones(len(contents), bool), {}
                for i, content in enumerate(contents):
                    spans = before[i] + [{"start": a, "end": b} for a, b in block.hits(words_of_text(content))[0]]
                    if spans:
                        changed[i] = cut_text(content, spans)
                        keep[i] = bool(words_of_text(changed[i]))
                texts = part.column(0)
                if changed:
                    new = pa.array([x.decode() for x in changed.values()], texts.type)
                    mask = np.zeros(len(contents), bool)
                    mask[list(changed)] = True
                    texts = pc.replace_with_mask(texts, pa.array(mask), new)
                arrays = [texts if n == text else part.column(1).field(n) for n in names]
                made = pa.RecordBatch.from_arrays(arrays, names=names)
                yield made if keep.all() else made.filter(pa.array(keep))

    return found.mapInArrow(cut, docs.schema)


def cut_text(content, leaks):
    """A UTF-8 text without the words in the given spans."""
    plain = content.translate(WORDY)
    cuts = merged((s["start"], s["end"]) for s in leaks)
    out, kept_to, number, at = [], 0, 0, 0
    for start, end in cuts:
        begin = stop = None
        while number < end:
            while plain[at] == 0x20:
                at += 1
            close = plain.find(b" ", at)
            close = len(plain) if close < 0 else close
            if number == start:
                begin = at
            at, stop, number = close, close, number + 1
        out.append(content[kept_to:begin])
        kept_to = stop
    out.append(content[kept_to:])
    return b"".join(out)
