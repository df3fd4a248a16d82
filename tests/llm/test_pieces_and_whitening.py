"""SentencePiece encoding against its library, and whitening against an eigendecomposition of the exact covariance."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from spindlewatch.llm import piece_agenda, queries, whitening
from spindlewatch.llm.piece_agenda import Pieces, encode_pieces, read_model
from spindlewatch.llm.whitening import fit_whitening, solved, triangular_factors, whiten

SMALL = "/root/testdata/sf0.001"


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def model():
    return read_model(queries.PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


# What random texts are made of: marks of spaces, pieces and what no piece has, byte pieces and control pieces as text.
PARTS = (
    "▁| |  |a|the|²|.|².|,|_|__|{|}|1|23|é|́|中|文字|\n|\t|\x00|\U0001f600|ﷺ|ß|\"|'s|<s>|</s>|<unk>|<0x0A>|"
    " |　|=|====|İ|----|ab|on|tion|Ａ|ing the"
).split("|")


@pytest.mark.parametrize("remembered", [piece_agenda.REMEMBERED, 3])
def test_texts_are_encoded_and_decoded_as_by_the_library(model, library, remembered):
    pieces, rng = Pieces(model, remembered), random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
        ids = library.encode(text, add_eos=True)
        assert pieces.encode(text).tolist() == ids
        assert pieces.agrees(text)
        assert pieces.decode(np.array(ids, np.int32)).decode() == library.decode(ids)


def test_any_ids_are_decoded_as_by_the_library(model, library):
    pieces, rng = Pieces(model), random.Random(4)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(259), rng.randrange(3, 259), 28705]) for _ in range(rng.randint(0, 8))]
        assert pieces.decode(np.array(ids, np.int32)).decode() == library.decode(ids)


def test_long_agendas_and_long_texts(model, library, monkeypatch):
    pieces, rng = Pieces(model), random.Random(5)
    texts = ["".join(rng.choice("abehnost") for _ in range(rng.randint(0, 400))) for _ in range(300)]
    assert all(pieces.merge("▁" + t) == pieces.merge_long("▁" + t) for t in texts)
    text = "  ".join([*texts, " " * 5000, "=" * 5000])
    monkeypatch.setattr(piece_agenda, "PART", 50)
    assert pieces.encode(text).tolist() == library.encode(text, add_eos=True)


def test_fragments_that_differ_are_told(model):
    pieces = Pieces(model)
    pieces.encode_fragment = lambda f: np.array([7], np.int32).tobytes() if f == " wrong" else Pieces.encode_fragment(pieces, f)
    pieces.known.encode = pieces.encode_fragment
    for text, right in (("all right", True), ("it is wrong, is it", False), ("", True), ("wrong", False), ("right", True)):
        pieces.encode(text)
        assert pieces.agrees(text) == right


def test_encode_pieces(docs, all_rows, no_docs, model, library):
    found = encode_pieces(docs, model)
    assert found.columns == [*[c for c in docs.columns if c not in ("ids", "decoded", "agrees")], "ids", "decoded", "agrees"]
    expected = []
    for i, text, *_ in all_rows:
        ids = library.encode(text or "", add_eos=True)
        expected.append((i, text, ids, library.decode(ids), True))
    assert ordered(map(tuple, found.select("doc_id", "text", "ids", "decoded", "agrees").collect())) == ordered(expected)
    assert encode_pieces(no_docs, model).collect() == []


def test_piece_query(spark, library):
    found = {r.doc_id: r for r in queries.op13_piece_round_trip(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_eos=True)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert tuple(found[doc_id]) == (doc_id, len(ids), digest, decoded, True)


# ---- whitening --------------------------------------------------------------------------------------


def exact(vectors):
    """(n, S, covariance) by whole numbers and fractions."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(row[i] for row in x) for i in range(dims)]
    far = [[n * a - b for a, b in zip(row, s)] for row in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in far), n**3)) for j in range(dims)] for i in range(dims)])
    return n, s, far, v


def check(spark, vectors, extra=(), components=8, **options):
    rows = [(i, v) for i, v in enumerate([*vectors, *extra])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    frame = frame.withColumns({"whitened": F.lit("x"), "n": F.lit(None).cast("int"), "part": F.lit("y")})
    model = fit_whitening(frame, components=components, **options)
    n, s, far, v = exact(vectors)
    assert (model.n, model.sums) == (n, s)
    values = np.linalg.eigvalsh(v)[::-1]
    k = model.components.shape[1]
    assert np.allclose(model.variances, values[:k], rtol=1e-9, atol=1e-9 * values[0])
    assert np.allclose(model.components.T @ model.components, np.eye(k), atol=1e-12)
    assert np.allclose(v @ model.components, model.components * model.variances, atol=1e-10 * values[0])
    assert np.allclose(model.explained, model.variances / np.trace(v), rtol=1e-6)
    assert model.identity_error <= 1e-6
    found = whiten(frame, model).collect()
    assert sorted(r.vec_id for r in found) == list(range(n))
    weights = model.components / np.sqrt(model.variances)
    for r in found:
        assert r.deviation == sum(a * a for a in far[r.vec_id])
        assert np.allclose(r.whitened, np.array([float(Fraction(a, n)) for a in far[r.vec_id]]) @ weights, atol=1e-7)
        assert (r.n, r.part) == (None, "y")
    return model


def test_whitening(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) * 0.2).tolist()
    vectors += vectors[:40]
    left_out = [None, [], [None] * 12, [0.1] * 11 + [None], [0.1] * 11 + [float("nan")], [0.1] * 11 + [float("inf")], [0.2] * 7, [1e300] * 12]
    assert check(spark, vectors, left_out).components.shape == (12, 8)


def test_whitening_of_badly_conditioned_vectors(spark):
    rng = np.random.default_rng(6)
    scale = np.logspace(4, -1, 10)
    basis = np.linalg.qr(rng.normal(size=(10, 10)))[0]
    check(spark, (rng.normal(size=(400, 10)) * scale @ basis).tolist(), components=4)


def test_whitening_of_few_directions(spark):
    """Fewer directions than components: the rest are not there, and a constant entry does no harm."""
    rng = np.random.default_rng(7)
    three = rng.integers(-3, 4, size=(200, 3))
    vectors = np.hstack([three, three[:, :1] * 2, np.full((200, 2), 5)]).astype(float).tolist()
    assert check(spark, vectors).components.shape == (6, 3)
    assert check(spark, [[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]]).components.shape == (2, 1)


def test_whitening_of_great_entries(spark):
    """Entries whose exact deviations do not fit 64 bits."""
    rng = np.random.default_rng(8)
    check(spark, (rng.normal(size=(150, 3)) * 1e9).tolist())


def test_whitening_of_nothing(spark):
    frame = spark.createDataFrame([(1, None), (2, []), (3, [None, 1.0])], "vec_id bigint, embedding array<float>")
    assert fit_whitening(frame) is None and fit_whitening(frame.limit(0)) is None
    assert whiten(frame, None).collect() == []
    for rows in ([(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
        model = fit_whitening(frame)
        assert model.n == len(rows) and model.components.shape == (2, 0)
        assert [list(r.whitened) for r in whiten(frame, model).collect()] == [[]] * len(rows)


def test_factors_make_rows_orthonormal():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 6)) * np.logspace(6, -6, 6)
    factors, rest = triangular_factors(lambda fs: (q := solved(x, fs)).T @ q, 500)
    q = solved(x, [*factors, rest])
    assert np.allclose(q.T @ q, np.eye(6), atol=1e-12)
    assert all(np.allclose(r, np.triu(r)) for r in [*factors, rest])


def test_whitening_query(spark):
    found = queries.op12_embedding_whitening(spark, SMALL).collect()
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert len(found) == 8 * len(rows) and {r.component for r in found} == set(range(1, 9))
    n, s, far, v = exact([r.embedding for r in rows])
    at = {r.vec_id: i for i, r in enumerate(rows)}
    values, vectors = np.linalg.eigh(v)
    for k in range(1, 9):
        mine = [r for r in found if r.component == k]
        e, w = values[-k], vectors[:, -k]
        plain = np.array([[float(a) / n for a in far[at[r.vec_id]]] for r in mine]) @ w / np.sqrt(e)
        white = np.array([r.whitened for r in mine])
        assert np.allclose(white * np.sign(white @ plain), plain, atol=1e-8)
        assert all(abs(r.explained / (e / np.trace(v)) - 1) < 1e-9 and r.identity_error < 1e-9 and r.n == n for r in mine)
        assert all(r.deviation == sum(a * a for a in far[at[r.vec_id]]) for r in mine)
