"""Whitening of embedding vectors by shifted Cholesky QR.

Entries become whole numbers, so that the number of vectors and the sums of their entries are exact. The centred
vectors, as rows X, are factored as X = QR without ever being stored: each pass over them solves the triangular
systems of the factors found so far, adds up the Gram matrix of the result, and Cholesky gives the next factor.
The first Gram matrix is shifted, so that it has a factor however badly conditioned X is; the passes after it make
Q orthonormal. The singular values and right singular vectors of the product of the factors are those of X: they
give the components. A Gram matrix has the square of the vectors' dimension, whatever their number; the tasks'
matrices are added up in a tree.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlewatch.llm.common import Shared, ship

ship(__name__)

# An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000

# Tasks that add up the matrices of all others, before one adds up theirs.
BRANCHES = 16

# Passes that orthogonalise, at most. Three are enough unless X is short of full rank.
PASSES = 6
ORTHONORMAL = 1e-12

# Rows of a batch that are worked on at a time.
SLICE = 4096

FITS = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: components as columns, by falling variance."""

    n: int
    sums: list
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def dims(self):
        return len(self.sums)


def _whole_numbers(column, dims):
    """(places, numbers): which rows of a list column can be used, and their entries as whole numbers."""
    size = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(size == dims)
    entries = column.take(pa.array(places)).flatten().cast(pa.float64())
    values = entries.to_numpy(zero_copy_only=False).reshape(len(places), dims)
    # Null entries come as NaN.
    scaled = np.floor(SCALE * np.where(np.isfinite(values), values, np.inf))
    good = (np.abs(scaled) < FITS).all(axis=1)
    return places[good], scaled[good].astype(np.int64) + OFFSET


def _most(numbers):
    return max(abs(int(numbers.max(initial=0))), abs(int(numbers.min(initial=0))))


def _from_mean(numbers, n, sums):
    """n * x - S, exactly: as int64 where that is wide enough, and as Python's integers elsewhere."""
    if n * (_most(numbers) + 1) + max(map(abs, sums), default=0) < FITS:
        return n * numbers - np.array(sums, np.int64)
    return n * numbers.astype(object) - np.array(sums, object)


def _centred(numbers, n, sums):
    return _from_mean(numbers, n, sums).astype(np.float64) / n


def solved(rows, factors):
    """Rows times the inverse of each upper triangular factor in turn, by substitution."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(r.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _slices(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _total(rows, vector, dims, first, merge, make):
    """Whatever ``make()`` gives for the vectors of one slice, merged over all: an array of doubles, or None.

    Every task merges its own, ``BRANCHES`` tasks merge those, and one task merges what is left.
    """
    kind = "__part binary"

    def of_task(batches):
        function, total = make(), None
        for batch in _slices(batches):
            places, numbers = _whole_numbers(batch.column(0), dims)
            if len(places):
                made = function(numbers)
                total = made if total is None else merge(total, made)
        yield from packed(total)

    def packed(total):
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["__part"])

    def of_parts(batches):
        total = None
        for batch in batches:
            for one in batch.column(0):
                made = np.frombuffer(one.as_py())
                total = made if total is None else merge(total, made)
        yield from packed(total)

    parts = rows.select(F.col(f"`{vector}`").alias("__v")).mapInArrow(of_task, kind)
    some = parts.repartition(BRANCHES).mapInArrow(of_parts, kind)
    whole = some.repartition(1).mapInArrow(of_parts, kind).first()
    return first if whole is None else np.frombuffer(whole[0])


def _gram(rows, vector, model, factors):
    n, sums = model
    dims = len(sums)
    shared = Shared(rows.sparkSession, (n, sums, factors))

    def make():
        n, sums, factors = shared.value()

        def run(numbers):
            q = solved(_centred(numbers, n, sums), factors)
            return (q.T @ q).ravel()

        return run

    return _total(rows, vector, dims, np.zeros(dims * dims), np.add, make).reshape(dims, dims)


def _merge_moments(a, b):
    """Number, mean and centred products of two sets of rows together."""
    k = int((np.sqrt(4 * len(a) - 3) - 1) / 2)
    n, d = a[0] + b[0], b[1 : k + 1] - a[1 : k + 1]
    products = a[k + 1 :] + b[k + 1 :] + np.outer(d, d).ravel() * (a[0] * b[0] / n)
    return np.concatenate([[n], a[1 : k + 1] + d * (b[0] / n), products])


def _covariance(rows, vector, model, weights):
    """Covariance of the projected vectors, centred before multiplying."""
    n, sums = model
    k = weights.shape[1]
    shared = Shared(rows.sparkSession, (n, sums, weights))

    def make():
        n, sums, weights = shared.value()

        def run(numbers):
            y = _centred(numbers, n, sums) @ weights
            mean = y.mean(axis=0)
            y = y - mean
            return np.concatenate([[len(y)], mean, (y.T @ y).ravel()])

        return run

    moments = _total(rows, vector, len(sums), None, _merge_moments, make)
    return moments[k + 1 :].reshape(k, k) / moments[0]


def common_size(rows, vector):
    """The commonest length of the vectors, and of several the greatest; 0 if there is none."""
    sizes = rows.select(F.size(F.col(f"`{vector}`")).alias("size")).where("size > 0").groupBy("size").count()
    best = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return best.size if best else 0


def sums_of(rows, vector, dims):
    """(n, S): how many vectors can be used, and the exact sums of their whole numbers."""

    def of_task(batches):
        n, sums = 0, [0] * dims
        for batch in _slices(batches):
            places, numbers = _whole_numbers(batch.column(0), dims)
            n += len(places)
            wide = numbers if len(places) * _most(numbers) < FITS else numbers.astype(object)
            sums = [s + int(x) for s, x in zip(sums, wide.sum(axis=0))]
        listed = pa.array([sums], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([pa.array([n]), listed], names=["__n", "__sums"])

    parts = rows.select(F.col(f"`{vector}`").alias("__v")).mapInArrow(of_task, "__n bigint, __sums array<decimal(38,0)>")
    places = parts.select("__n", F.posexplode("__sums").alias("at", "sum"))
    found = places.groupBy("at").agg(F.sum("__n").alias("n"), F.sum("sum").alias("sum")).collect()
    sums = {r["at"]: int(r["sum"]) for r in found}
    return (found[0]["n"] if found else 0), [sums.get(i, 0) for i in range(dims)]


def triangular_factors(gram, n):
    """The factors of shifted Cholesky QR, given ``gram(factors)``, and what remains of the last Gram matrix.

    X'X is F'F for F the remainder times the factors, last to first.
    """
    factors = []
    for i in range(PASSES):
        g = gram(factors)
        dims = len(g)
        if i and np.abs(g - np.eye(dims)).max() <= ORTHONORMAL:
            return factors, np.linalg.cholesky(g).T
        shift = 11 * (n * dims + dims * (dims + 1)) * np.finfo(float).eps / 2 * np.trace(g)
        try:
            if i == 0:
                raise np.linalg.LinAlgError
            factors.append(np.linalg.cholesky(g).T)
        except np.linalg.LinAlgError:
            if not np.trace(g) > 0:
                break
            # Of no use beyond one: a factor only has to be well conditioned.
            factors.append(np.linalg.cholesky(g + min(shift, np.trace(g)) * np.eye(dims)).T)
    # Directions that X does not have keep Q from becoming orthonormal; its Gram matrix tells how far it is.
    values, vectors = np.linalg.eigh(gram(factors))
    return factors, np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


def fit_whitening(rows, vector="embedding", components=8):
    """The whitening of all vectors of ``rows``: a :class:`Whitening`, or None if there is nothing to whiten.

    A vector is left out if it is null, has null entries or ones that are not finite or do not fit 64 bits when
    scaled, or is not of the commonest length (of several lengths the greatest). Every other row counts, equal ones
    each. Components are at most ``components`` and at most those that the vectors vary along: a variance below
    rounding error of the greatest one counts as none, so a single vector, or only equal ones, have no component.
    """
    dims = common_size(rows, vector)
    n, sums = sums_of(rows, vector, dims) if dims else (0, [])
    if not n:
        return None
    model = n, sums
    trace = []

    def gram(factors):
        found = _gram(rows, vector, model, factors)
        trace.append(np.trace(found))
        return found

    factors, rest = triangular_factors(gram, n)
    product = rest
    for r in reversed(factors):
        product = product @ r
    _, singular, directions = np.linalg.svd(product)
    variances = singular**2 / n
    count = min(components, int((variances > variances[0] * dims * np.finfo(float).eps * 4).sum()))
    chosen = directions[:count].T
    # Either sign is right; the entry of greatest size is made positive.
    chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(axis=0), range(count)])
    variances = variances[:count]
    error = 0.0
    if count:
        error = float(np.abs(_covariance(rows, vector, model, chosen / np.sqrt(variances)) - np.eye(count)).max())
    return Whitening(n, sums, chosen, variances, variances * n / trace[0] if count else variances, error)


def whiten(rows, model, vector="embedding", keep=None):
    """Rows with a vector that can be used (see :func:`fit_whitening`), with ``whitened``, its coordinates along the
    components in units of their deviation, and ``deviation``, the exact sum over dimensions of (n * x - S)^2.

    ``model`` None gives no rows. Columns named ``whitened`` and ``deviation`` are replaced; ``keep`` names the
    columns to keep, all if it is not given. Equal rows have equal results.
    """
    kept = [c for c in (rows.columns if keep is None else keep) if c not in ("whitened", "deviation")]
    made = T.StructType.fromDDL("whitened array<double>, deviation decimal(38,0)")
    schema = T.StructType([*[rows.schema[c] for c in kept], *made])
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    shared = Shared(rows.sparkSession, model)

    def run(batches):
        model = shared.value()
        weights, wide = model.components / np.sqrt(model.variances), pa.decimal128(38, 0)
        for batch in _slices(batches):
            places, numbers = _whole_numbers(batch.column(batch.num_columns - 1), model.dims)
            far = _from_mean(numbers, model.n, model.sums)
            if far.dtype == object or _most(far) ** 2 * model.dims >= FITS:
                deviation = pa.array([sum(int(x) ** 2 for x in row) for row in far], wide)
            else:
                deviation = pa.array((far**2).sum(axis=1)).cast(wide)
            white = (far.astype(np.float64) / model.n) @ weights
            offsets = np.arange(len(places) + 1, dtype=np.int32) * weights.shape[1]
            arrays = [
                *batch.select(range(batch.num_columns - 1)).take(pa.array(places)).columns,
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel())),
                deviation,
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "whitened", "deviation"])

    source = rows.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{vector}`").alias("__v"))
    return source.mapInArrow(run, schema)
