"""Reference data: topping up the fleet, handing out templates, one row per machine."""

from pyspark.sql import functions as F

from spindlewatch import names
from spindlewatch.functions.labels import critical_limit
from spindlewatch.operators.numbering import dense_index, nth_smallest

# Up to this many template rows, and bytes of text, a copy goes to every task.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def check_machine_count(count, most=None):
    """The fleet size as an integer, at least one, and no more than ``most`` if that is given."""
    try:
        number = int(str(count), 10)
    except ValueError:
        raise ValueError(f"machine count {count!r} is not an integer") from None
    if number < names.MIN_MACHINES:
        raise ValueError(f"machine count must be at least {names.MIN_MACHINES:,}")
    if most is not None and number > most:
        raise ValueError(f"machine count must be between {names.MIN_MACHINES:,} and {most:,} inclusive")
    return number


def top_up(candidates, existing, target, seq="seq"):
    """The first candidates, by the unique ``seq``, that bring ``existing`` rows to ``target``; none if there are
    enough.

    The last ``seq`` that is needed is found from counts, and the candidates are then read up to it: nothing is
    sorted, and what is not taken need not be read.
    """
    needed = max(0, target - existing)
    if needed == 0:
        return candidates.limit(0)
    last = nth_smallest(candidates, seq, needed)
    return candidates if last is None else candidates.where(F.col(seq) <= F.lit(last))


def _bytes(column):
    """About what a value takes in memory."""
    return F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0)) + 16


def round_robin(candidates, templates, seq="seq", line="line"):
    """Candidates with the template whose turn it is: the one at position ``seq`` modulo their number, in
    the order of ``line``. Adds the templates' columns, less ``line``."""
    size = templates.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(line).alias("first"),
        F.max(line).alias("last"),
        F.sum(sum((_bytes(c) for c in templates.columns), F.lit(0))).alias("bytes"),
    ).first()
    if size.rows == 0:
        raise ValueError("there are no profile templates to hand out")
    numbered = dense_index(templates, line, "_turn", (size.first, size.last)).drop(line)
    if size.rows <= BROADCAST_ROWS and size.bytes <= BROADCAST_BYTES:
        numbered = F.broadcast(numbered)
    turn = F.pmod(F.col(seq), F.lit(size.rows))
    return candidates.withColumn("_turn", turn).join(numbered, "_turn").drop("_turn")


def last_per_key(rows, key="serialNum", seq="seq"):
    """One row per key: the one with the greatest ``seq``, as when rows are put into a map in that order.

    Copies are merged before the shuffle, so a key with very many copies is not a hot spot.
    """
    others = [c for c in rows.columns if c != key]
    last = F.max_by(F.struct(*others), seq).alias("_last")
    return rows.groupBy(key).agg(last).select(*[key if c == key else F.col(f"_last.{c}").alias(c) for c in rows.columns])


def put_rows(table, rows, key="serialNum", seq="seq"):
    """The table after ``rows`` have been put into it in the order of ``seq``.

    Stored rows count as put before all others, so that one pass resolves both copies among the new rows and
    rows that replace stored ones.
    """
    stored = table.withColumn(seq, F.lit(-(2**63)).cast("bigint"))
    new = rows.select(*table.columns, F.col(seq).cast("bigint").alias(seq))
    return last_per_key(stored.unionByName(new), key, seq).select(*table.columns)


def complete_profiles(rows):
    """Rows with the profile's columns: fault odds from the template, the critical limit from the warning."""
    return rows.withColumn("faultyOdds", F.col("faultyFraction")).withColumn(
        "criticalTemp", critical_limit(F.col("warningTemp"))
    )
