"""Exact Jaccard join of documents on word shingles, down to the connected components of its links.

1. Every text becomes the set of its shingles' hashes. Equal sets are one class.
2. Shingles have one order for all sets: those in a fixed share of the hash space first, rare ones before
   frequent ones, and then the others by hash. Sets as similar as asked share a shingle among their first ones, the prefix. Shingles that
   only one set has are counted, but no index list is made for them.
3. Index lists with the same leader, the member with most copies, are one list. A list is cut into blocks of similar set sizes; a pair of
   blocks is skipped when their sizes, or the positions of the shared shingle in their sets, leave too few
   shingles to share, and when all members are known to be connected.
4. Members are compared with the leader of their block first, which connects most of a group of copies. What
   is not yet connected is compared block against block; there a set's answers (how much it shares with every
   member) are those of the set before it, changed by the lists of the shingles in which the two differ.

No list, component or pair is gathered on the driver, and no group is handed to one task beyond a block pair.
"""

from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from spindlewatch.llm.common import LOWERED, map_texts, ship, sized, written
from spindlewatch.llm.components import components

ship(__name__)

BLOCK = 256
REMEMBERED = 300_000
MIX = np.uint64(0x9E3779B97F4A7C15)
SIGN = np.uint64(1 << 63)


class WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(values):
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


def shingle_hashes(text, size, hashes):
    """Different shingles of a UTF-8 text as sorted 64-bit hashes: of ``size`` words, or all of fewer words."""
    words = text.translate(LOWERED).split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    length = min(n, size)
    out = mixed(values[: n - length + 1] + np.uint64(length))
    for i in range(1, length):
        out = mixed(out + values[i : n - length + 1 + i])
    return np.unique(out)


def required(n, percent):
    """Least number of shingles that a set of ``n`` shares with any similar set."""
    return -(-percent * n // 100)


def signed(values):
    """Hashes as signed numbers in the same order."""
    return (values ^ SIGN).view(np.int64)


def _sets(docs, text, id_column, size, percent, share):
    limit = np.uint64(int(share * 2**64) - 1)

    def make():
        hashes = WordHashes()

        def run(texts):
            counts, keys, lows, offsets, firsts = [], [], [], [0], []
            for content in texts:
                values = shingle_hashes(content, size, hashes)
                n = len(values)
                first = int(np.searchsorted(values, limit, "right"))
                low = values[: max(first, n - required(n, percent) + 1)] if n else values
                counts.append(n)
                keys.append(xxhash.xxh3_128_digest(values.tobytes()) if n else None)
                lows.append(signed(low))
                offsets.append(offsets[-1] + len(low))
                firsts.append(first)
            flat = np.concatenate(lows) if lows else np.zeros(0, np.int64)
            return [
                pa.array(counts, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),
                pa.array(firsts, pa.int32()),
            ]

        return run

    fields = [
        ("n", pa.int64(), "bigint"),
        ("key", pa.binary(), "binary"),
        ("low", pa.list_(pa.int64()), "array<bigint>"),
        ("n_first", pa.int32(), "int"),
    ]
    named = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("_text"))
    return map_texts(named, "_text", fields, make, ["doc_id"])


def _full_sets(docs, text, id_column, size, wanted):
    """(node, tokens) of the wanted (node, rep, key); a rep's text is told from others of its id by the key."""

    def make():
        hashes = WordHashes()

        def run(texts):
            sets = [shingle_hashes(t, size, hashes) for t in texts]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = signed(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
            return [
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64())),
            ]

        return run

    named = docs.select(F.col(id_column).cast("bigint").alias("rep"), F.col(text).alias("_text"))
    side = sized(wanted.withColumnRenamed("rep", "_rep"))
    chosen = named.join(side, named["rep"].eqNullSafe(F.col("_rep"))).drop("_rep")
    fields = [("_found", pa.binary(), "binary"), ("tokens", pa.list_(pa.int64()), "array<bigint>")]
    found = map_texts(chosen, "_text", fields, make, ["node", "key"])
    return found.where("_found = key").select("node", "tokens").dropDuplicates(["node"])


def _classes(sets):
    """Equal sets as one: (key, rep, copies, n, low, n_first, node). A node is a number of its own."""
    grouped = (
        sets.where("n > 0")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"),
            F.first("low").alias("low"),
            F.first("n_first").alias("n_first"),
        )
    )
    # Several texts under one id have the same rep; all but one of them get another number, as have null ids.
    turn = F.row_number().over(Window.partitionBy("rep").orderBy("key"))
    return grouped.withColumn("node", F.when(turn == 1, F.col("rep"))).withColumn(
        "node", F.coalesce("node", F.xxhash64("key"))
    )


def _prefixes(classes, percent, share):
    """(token, node, pos, n) of the tokens in prefixes that other sets have, too."""
    limit = int(share * 2**64) - 1 - 2**63
    tokens = classes.select("node", F.explode("low").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    shared = tokens.join(counts, "token").withColumn("late", (F.col("token") > limit).cast("int"))
    sized = shared.join(classes.select("node", "n", "n_first"), "node")
    # Late ones were cut off by hash, so they are in that order; by another, a set's first ones might be cut off.
    rank = F.row_number().over(Window.partitionBy("node").orderBy("late", F.when(F.col("late") == 0, F.col("sets")), "token"))
    first_shared = F.sum(1 - F.col("late")).over(Window.partitionBy("node"))
    alone = F.col("n_first") - first_shared
    reach = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    return sized.withColumn("pos", rank + alone).where(F.col("pos") <= reach).select("token", "node", "pos", "n")


def _members(prefixes, classes):
    """(list, node, pos, n, copies): index lists by their leader, the member with most copies.

    Lists of one leader are one list: the members of a group of copies share many shingles, and would
    otherwise meet once for each.
    """
    rows = prefixes.join(classes.select("node", "copies"), "node")
    leaders = (
        rows.groupBy("token")
        .agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("copies", "node")).alias("lead"))
        .where("size > 1")
        .select("token", F.col("lead.node").alias("list"))
    )
    grouped = rows.join(leaders, "token").groupBy("list", "node")
    return grouped.agg(F.min("pos").alias("pos"), F.first("n").alias("n"), F.first("copies").alias("copies"))


def _enough(percent, shared, n, m):
    return F.lit(100) * shared >= F.lit(percent) * (n + m - shared)


def _leader_links(members, full, percent):
    """Links between members of a block and the leaders of their own and neighbouring blocks."""
    leaders = members.groupBy("list", "band").agg(F.max(F.struct("copies", "node", "n")).alias("lead"))
    near = leaders.select("list", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])).alias("band"), "lead")
    pairs = (
        members.join(near, ["list", "band"])
        .where(F.col("node") != F.col("lead.node"))
        .where(F.lit(percent) * F.greatest("n", "lead.n") <= F.lit(100) * F.least("n", "lead.n"))
        .select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b"))
        .distinct()
    )
    first = full.select(F.col("node").alias("a"), F.col("tokens").alias("s"))
    second = full.select(F.col("node").alias("b"), F.col("tokens").alias("t"))
    shared = F.size(F.array_intersect("s", "t"))
    compared = pairs.join(first, "a").join(second, "b")
    return compared.where(_enough(percent, shared, F.size("s"), F.size("t"))).select("a", "b")


def _block_pairs(members, percent):
    """(pair, node, pos, n, label): members of pairs of blocks that may hold links between components."""
    per_list = members.groupBy("list").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.struct("copies", "label")).alias("lead")
    )
    open_ = (
        members.join(per_list.where("low != high").select("list", F.col("lead.label").alias("main")), "list")
        .withColumn("side", (F.col("label") == F.col("main")).cast("int"))
        .select("list", "band", "side", "node", "pos", "n", "label")
    )
    spread = open_.groupBy("list", "band", "side").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = open_.join(spread, ["list", "band", "side"]).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks"))
    )
    blocks = placed.groupBy("list", "band", "side", "block").agg(
        F.min("n").alias("n"), F.max(F.col("n") - F.col("pos")).alias("rest")
    )
    at = F.struct("band", "side", "block")
    left = blocks.select("list", F.col("band").alias("l_band"), at.alias("l"), F.col("n").alias("l_n"), F.col("rest").alias("l_rest"))
    right = blocks.select(
        "list", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("l_band"), at.alias("r"), F.col("n").alias("r_n"), F.col("rest").alias("r_rest")
    )
    least = F.ceil((F.col("l_n") + F.col("r_n")) * F.lit(percent) / F.lit(100 + percent) - 1e-6)
    pairs = (
        left.join(right, ["list", "l_band"])
        # Each pair once: within a band in order, and with the band above.
        .where((F.col("r.band") > F.col("l_band")) | (F.col("l") <= F.col("r")))
        .where("l.side = 0 or r.side = 0")
        .where(1 + F.least("l_rest", "r_rest") >= least)
        .select("list", F.xxhash64("list", "l", "r").alias("pair"), "l", "r")
    )
    sides = pairs.select("list", "pair", F.explode(F.array_distinct(F.array("l", "r"))).alias("at"))
    rows = placed.select("list", at.alias("at"), "node", "pos", "n", "label")
    return rows.join(sides, ["list", "at"]).select("pair", "node", "n", "label")


def _links_within(percent):
    """A function from the members of a pair of blocks to links that connect them."""

    def run(group):
        nodes = group.column("node").to_numpy()
        labels = group.column("label").to_numpy()
        lists = group.column("tokens").combine_chunks()
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy()
        count = len(nodes)
        owner = np.repeat(np.arange(count), np.diff(offsets))
        values = values[offsets[0] : offsets[-1]]
        # Index lists of the tokens that more than one member has.
        order = np.lexsort((owner, values))
        tokens, starts = np.unique(values[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        code = np.searchsorted(tokens, values)
        common = (ends - starts)[code] > 1
        owners = owner[order]
        sizes = np.diff(offsets)
        own = [code[(a - offsets[0]) : (b - offsets[0])][common[(a - offsets[0]) : (b - offsets[0])]] for a, b in zip(offsets, offsets[1:])]

        def answers(codes):
            if not len(codes):
                return np.zeros(count, np.int64)
            return np.bincount(np.concatenate([owners[starts[c] : ends[c]] for c in codes.tolist()]), minlength=count)

        # Members of one size and component follow one another: those are the ones most alike.
        turn = np.lexsort((sizes, labels))
        group_of = labels.copy()
        found, before, shared = [], np.zeros(0, np.int64), np.zeros(count, np.int64)
        for i in turn.tolist():
            here = own[i]
            lost, new = np.setdiff1d(before, here, True), np.setdiff1d(here, before, True)
            if len(lost) + len(new) < len(here):
                shared = shared + answers(new) - answers(lost)
            else:
                shared = answers(here)
            before = here
            near = 100 * shared >= percent * (sizes + sizes[i] - shared)
            for j in np.flatnonzero(near & (group_of != group_of[i])).tolist():
                if group_of[j] != group_of[i]:
                    found.append((nodes[i], nodes[j]))
                    group_of[group_of == group_of[j]] = group_of[i]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def similar_components(docs, text="text", id_column="doc_id", size=3, percent=90, share=None):
    """Per row: doc_id, n_shingles, and component_id, the smallest id that links lead to.

    Two texts link when their shingle sets (of ``size`` words; of all words if there are fewer) share at least
    ``percent`` of their union; letters A-Z count as a-z. Null and empty texts, and those of white space, have
    no shingle and no link: their component is their own id. Rows are told apart by their text: rows with one
    id and different texts are linked only if the texts are. Rows with a null id take part; the component is
    null if none of its rows has an id. ``share`` of the hash space is counted to order shingles by frequency.
    Sets are compared by 64-bit hashes of shingles.
    """
    share = share or min(0.9, max(0.05, 1.5 * (1 - percent / 100)))
    sets = written(_sets(docs, text, id_column, size, percent, share), "sets")
    classes = written(_classes(sets), "classes")
    prefixes = written(_prefixes(classes, percent, share), "prefixes")
    width = log(100 / percent) * 1.001 if percent < 100 else 1e-9
    members = _members(prefixes, classes).withColumn("band", F.floor(F.log("n") / F.lit(width)))
    members = written(members, "members")

    wanted = members.select("node").distinct().join(classes.select("node", "rep", "key"), "node")
    full = written(_full_sets(docs, text, id_column, size, wanted), "full")
    links = written(_leader_links(members, full, percent), "links")
    known = components(links)
    labelled = members.join(known, "node", "left").withColumn("label", F.coalesce("label", "node"))
    pairs = _block_pairs(written(labelled, "members"), percent).join(full, "node")
    rest = pairs.groupBy("pair").applyInArrow(_links_within(percent), "a bigint, b bigint")
    links = written(links.union(rest), "links")

    connected = components(links)
    nodes = classes.select("key", "node", "rep").join(connected, "node", "left")
    nodes = nodes.withColumn("label", F.coalesce("label", "node")).select("key", "label", "rep")
    lowest = nodes.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_key = nodes.join(lowest, "label").select("key", "component_id")
    rows = sets.select("doc_id", "n", "key").join(by_key, "key", "left")
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
