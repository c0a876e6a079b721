"""Whitening against a plain eigendecomposition."""

import math

import numpy as np
import pytest

from tallyhouse.llm import registry, whitening

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, dim string"


def plain(rows, k=4):
    """(vec_id, component) -> (n, deviation, |whitened|, explained) of (vec_id, vector) rows."""
    rows = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in rows})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    cov = centred.T @ centred / n
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1], w[:, ::-1]
    out = []
    for i, x in rows:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        z = (np.array(x, float) - np.array(sums) / n) @ w
        out += [(i, c + 1, n, deviation, abs(z[c]) / math.sqrt(e[c]), e[c] / e.sum()) for c in range(min(k, len(e))) if e[c] > 1e-9 * e[0]]
    return out


def same(found, want):
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in found), key=repr)
    want = sorted(want, key=repr)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-9, atol=1e-9)


def test_given_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = registry.QUERIES["op13_shifted_cholesky_whitening"](spark, SF_DIR).collect()
    same(found, plain([tuple(r) for r in rows]))
    assert len({r.identity_error for r in found}) == 1 and 0 <= found[0].identity_error < 1e-9


@pytest.mark.parametrize("scale", [1.0, 1e3])
def test_dropped_rows_copies_and_dependent_dimensions(spark, scale):
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(60, 5)) * scale * [1, 5, 0.2, 0.01, 3]).astype(np.float32)
    vectors = [[float(c) for c in v] + [float(v[0]), 2.0] for v in base]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(100 + i, vectors[7]) for i in range(80)] + [(7, vectors[7]), (None, vectors[3])]
    bad = [(900, None), (901, [*vectors[0][:6], None]), (902, [float("nan")] * 7), (903, [float("inf"), *vectors[0][1:]]), (904, []), (905, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 1, "x", "d") for i, v in rows + bad], SCHEMA)
    found = whitening.whitened(frame.repartition(7)).collect()
    same(found, plain(rows))
    assert found[0].identity_error < 1e-6


def test_factor_reproduces_the_rows(spark):
    """A = Q R: R'R is the Gram matrix of the centred fit list, badly conditioned as it is."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 6)) @ np.diag([1000, 100, 10, 1, 0.3, 0.1])
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    fitted = whitening.fit_whitening(whitening.integer_vectors(frame))
    x = np.unique(np.floor(base * 256), axis=0)
    gram = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    assert np.allclose(fitted.r.T @ fitted.r, gram, rtol=1e-10, atol=gram.max() * 1e-13)
    assert np.allclose(fitted.r, np.triu(fitted.r))


def test_tables_without_a_spread(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(i, [1.0, 2.0], 1, "", "") for i in range(5)], SCHEMA)
    assert whitening.whitened(one).collect() == []
    huge = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1e16, 1.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whitened(huge).collect()} == {None}


def test_gram_matrices_of_many_tasks_take_a_few_jobs(spark):
    """The number of jobs does not follow the number of tasks or groups of them."""
    rows = np.random.default_rng(5).integers(-900, 900, (400, 3))
    cells = [(bytearray(c),) for c in whitening._packed(rows)]
    fit = spark.createDataFrame(cells, "x binary").repartition(144)
    spark.sparkContext.setJobGroup("gram", "gram")
    gram = whitening._gram(fit, 3, 3, lambda x: x.astype(float))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("gram")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert np.array_equal(gram, rows.T @ rows)
    assert len(jobs) <= 10
