import numpy as np
import pyarrow.parquet as pq
import pytest

from lodgeflow.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, n int, white string, x string"


def exact(vectors, k=16):
    """Brute force: whole numbers, exact sums and the full eigendecomposition."""
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    unique = np.unique(x, axis=0)
    n, sums = len(unique), unique.sum(axis=0)
    away = (n * unique - sums) / n
    values, vectors = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(values)[::-1][:k]
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return n, deviation, ((n * x - sums) / n) @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def agree(rows, ids, vectors, k=16):
    """Rows of (id, component, n, deviation, whitened, explained, error) against brute force, up to one sign each."""
    n, deviation, white, explained = exact(vectors, k)
    got = np.zeros_like(white)
    place = {i: r for r, i in enumerate(ids)}
    assert len(rows) == white.size
    for i, c, count, away, value, share, error in rows:
        assert count == n and away == deviation[place[i]] and error <= 1e-4
        assert share == pytest.approx(explained[c - 1], rel=1e-9)
        got[place[i], c - 1] = value
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-7


def flat(out):
    out = out.select("vec_id", "white.*").collect()
    return [(r.vec_id, c + 1, r.n, r.deviation, w, e, r.identity_error) for r in out for c, (w, e) in enumerate(zip(r.whitened, r.explained))]


def test_query_equals_brute_force(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    order = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    got = queries.op12_whitening(spark, SF).select(*order)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    agree([tuple(r) for r in got.collect()], table["vec_id"], table["embedding"])


def test_broken_repeated_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((60, 5)) * [3, 2, 1, 0.5, 0.2]).astype(np.float32)
    vectors[40:] = vectors[0]  # a third of all rows is one vector
    rows = [(i, v.tolist(), 0, "a", "b") for i, v in enumerate(vectors)]
    broken = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] + [0.0] * 4, [float("inf")] + [0.0] * 4, [1.0, 2.0]]
    table = spark.createDataFrame(rows + [(90 + k, v, 0, "a", "b") for k, v in enumerate(broken)], SCHEMA)
    out = whitening.whitened(table)
    assert set(out.columns) == {"vec_id", "n", "white", "x"}
    agree(flat(out), range(60), vectors, 5)


def test_null_and_repeated_ids_are_kept(spark):
    vectors = [[float(a), float(b)] for a in range(3) for b in range(3)]
    table = spark.createDataFrame([(None if k < 2 else 7, v, 0, "a", "b") for k, v in enumerate(vectors)], SCHEMA)
    out = whitening.whitened(table)
    assert [r[0] for r in out.select("vec_id").collect()].count(7) == 7 and out.count() == 9


def test_components_without_variance_are_left_out(spark):
    line = [(k, [float(k), 2.0 * k, 5.0], 0, "a", "b") for k in range(9)]
    out = whitening.whitened(spark.createDataFrame(line, SCHEMA)).collect()
    assert len(out) == 9 and all(len(r.white.whitened) == 1 for r in out)
    same = spark.createDataFrame([(k, [1.0, 2.0], 0, "a", "b") for k in range(4)], SCHEMA)
    assert whitening.whitened(same).count() == 0


def test_empty_tables(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None, 0, "a", "b")], SCHEMA)).count() == 0


def test_huge_entries(spark):
    """Sums stay exact, and deviations beyond 64 bits are null."""
    table = spark.createDataFrame([(1, [1e30, 0.0], 0, "a", "b"), (2, [-1e30, 1.0], 0, "a", "b"), (3, [0.0, 2.0], 0, "a", "b")], SCHEMA)
    out = whitening.whitened(table).collect()
    assert {r.white.deviation for r in out if r.vec_id in (1, 2)} == {None} and len(out) == 3


def test_a_long_flat_spectrum_is_certified():
    """More dimensions than the block holds, neighbouring eigenvalues a hundredth apart."""
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    values = np.linspace(4, 1, 300)
    matrix = (basis * values) @ basis.T
    passes = []

    def times(q):
        passes.append(q.shape[1])
        return matrix @ q

    found, vectors = whitening._leading(times, 300, 16)
    assert np.allclose(found, values[:16], rtol=1e-12)
    assert np.abs(np.abs((basis[:, :16] * vectors).sum(axis=0)) - 1).max() < 1e-12
    assert max(passes) == 32 and len(passes) < 400
    small = []

    def small_times(q):
        small.append(1)
        return np.diag([3.0, 2.0, 1.0]) @ q

    assert np.allclose(whitening._leading(small_times, 3, 3)[0], [3, 2, 1])
