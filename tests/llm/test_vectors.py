"""Whitening and exact search against brute force, and the qd solver against another one."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.llm import top_k, vectors, whitening
from hearthline.llm.qd import right_singular
from hearthline.llm.top_k import exact_top_k
from hearthline.llm.whitening import whiten

# Columns with the names of results, which no operator may read.
ROWS = "vec_id long, embedding array<float>, n string, score string, rank string, row string, pivot string"


def table(spark, rows, kind=ROWS):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x", "x") for i, v in rows], kind)


def cloud(n, size, seed=1, spread=0.2):
    return np.random.default_rng(seed).normal(0, spread, (n, size)).astype(np.float32).tolist()


ODD = [
    (900, None),
    (901, []),
    (902, [0.5, None, 0.1, 0.2, 0.3, 0.4]),
    (903, [0.5, math.nan, 0.1, 0.2, 0.3, 0.4]),
    (904, [0.5, math.inf, 0.1, 0.2, 0.3, 0.4]),
    (905, [0.5, 0.1]),
    (None, None),
]


def whole(rows, size):
    return [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]


# --- qd solver ------------------------------------------------------------------------------


def matrices():
    draw = np.random.default_rng(3)
    turn = np.linalg.qr(draw.standard_normal((40, 40)))[0]
    yield "one", np.array([[3.0]])
    yield "random", draw.standard_normal((30, 30))
    yield "triangle", np.linalg.qr(draw.standard_normal((200, 64)))[1]
    yield "identity", np.eye(12)
    yield "singular diagonal", np.diag(np.arange(9.0))
    yield "zero", np.zeros((4, 4))
    yield "repeated values", np.diag(np.r_[np.ones(20), np.full(20, 2.0)]) @ turn.T
    yield "graded", np.diag(10.0 ** (-np.arange(40) / 4)) @ turn.T
    few = np.zeros((40, 40))
    few[:3] = draw.standard_normal((3, 40))
    yield "rank three", few
    chain = np.diag(np.abs(np.arange(-10, 11.0)) + 2) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield "nearly equal pairs", np.linalg.cholesky(chain).T
    yield "pairs three times", np.kron(np.eye(3), np.linalg.cholesky(chain).T) + np.diag(np.full(62, 1e-12), 1)


@pytest.mark.parametrize("name, matrix", list(matrices()), ids=[n for n, _ in matrices()])
def test_values_and_vectors(name, matrix):
    values, directions = right_singular(matrix)
    expected = np.linalg.svd(matrix, compute_uv=False)
    top = max(expected[0], 1e-300)
    assert np.abs(np.sqrt(values) - expected).max() <= 1e-13 * top
    assert np.abs(directions.T @ directions - np.eye(len(matrix))).max() < 1e-11
    assert np.abs(matrix.T @ matrix @ directions - directions * values).max() <= 1e-13 * top**2


def test_small_values_keep_their_digits():
    """A bidiagonal matrix determines its values to high relative accuracy; dqds finds them so."""
    diag, upper = 10.0 ** -np.arange(0, 30, 2.0), 0.5 * 10.0 ** -np.arange(1, 29, 2.0)
    values, _ = right_singular(np.diag(diag) + np.diag(upper, 1))
    from fractions import Fraction

    product = Fraction(1)
    for x in diag.tolist():
        product *= Fraction(x) ** 2
    found = Fraction(1)
    for x in values.tolist():
        found *= Fraction(x)
    assert abs(float(found / product) - 1) < 1e-12  # the determinant, which is the product of the diagonal


# --- whitening ------------------------------------------------------------------------------


def check_whitened(rows, got, size, components=32):
    found = whole(rows, size)
    x = np.array([[c + 1_000_000 for c in v] for _, v in found], dtype=object)
    n, sums = len(found), x.sum(axis=0)
    deviations = sorted(int(((n * r - sums) ** 2).sum()) for r in x)
    centred = ((n * x - sums) / n).astype(float)
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1]
    kept = min(components, int((values > 1e-11 * values[0]).sum()))
    assert len(got) == n * kept
    assert {r["component"] for r in got} == set(range(1, kept + 1))
    assert {r["n"] for r in got} == {n}
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == deviations
    explained = {r["component"]: r["explained"] for r in got}
    assert np.allclose([explained[c + 1] for c in range(kept)], values[:kept] / values.sum(), rtol=1e-9)
    assert len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-9
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    ids = [i for i, _ in found]
    if len(set(ids)) == len(ids):
        y = np.array([[by_id[i][c + 1] for c in range(kept)] for i in ids])
        # Directions come back from the rows; they are unit eigenvectors.
        directions = np.linalg.lstsq(centred, y * np.sqrt(values[:kept]), rcond=1e-12)[0]
        assert np.abs(covariance @ directions - directions * values[:kept]).max() < 1e-9 * values[0]
        assert np.abs(directions.T @ directions - np.eye(kept)).max() < 1e-6
        assert np.abs(y.T @ y / n - np.eye(kept)).max() < 1e-8


def test_whitening_is_that_of_brute_force(spark):
    rows = [(i, v) for i, v in enumerate(cloud(300, 6))] + ODD
    check_whitened(rows, whiten(table(spark, rows).repartition(7)).collect(), 6)


def test_whitening_of_many_tasks_and_few_components(spark, monkeypatch):
    monkeypatch.setattr(vectors, "FAN", 3)
    rows = [(i, v) for i, v in enumerate(cloud(400, 40))]
    check_whitened(rows, whiten(table(spark, rows).repartition(20), 5).collect(), 40, 5)


def test_dependent_and_constant_dimensions_have_no_component(spark):
    rows = [(i, [v[0], v[0], 0.25, v[1], v[2], v[3] / 64]) for i, v in enumerate(cloud(200, 4))]
    got = whiten(table(spark, rows)).collect()
    check_whitened(rows, got, 6)
    assert {r["component"] for r in got} == {1, 2, 3, 4}


def test_large_offsets_lose_nothing(spark):
    rows = [(i, [v[0] + 2.0**20, v[1] - 2.0**18, v[2], v[0] + v[1] + 2.0**20]) for i, v in enumerate(cloud(150, 3, spread=4))]
    wide = ROWS.replace("array<float>", "array<double>")
    check_whitened(rows, whiten(table(spark, rows, wide)).collect(), 4)


def test_repeated_rows_and_ids_each_count(spark):
    rows = [(i % 5 if i % 7 else None, v) for i, v in enumerate(cloud(60, 3) * 2)]
    got = whiten(table(spark, rows)).collect()
    check_whitened(rows, got, 3)
    assert sum(r["vec_id"] is None for r in got) == 3 * sum(i is None for i, _ in rows)


@pytest.mark.parametrize("rows", [[], ODD, [(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(4)]])
def test_nothing_to_whiten(spark, rows):
    rows = [r for r in rows if r[0] != 905]
    assert whiten(table(spark, rows)).collect() == []


def test_too_large_for_whole_numbers(spark):
    wide = ROWS.replace("array<float>", "array<double>")
    with pytest.raises(Exception, match="64"):
        whiten(table(spark, [(1, [1e300, 0.0]), (2, [0.0, 1.0])], wide)).collect()


# --- exact search ---------------------------------------------------------------------------


def brute(rows, size, asks, k):
    found = whole(rows, size)
    out = []
    for at, (i, q) in enumerate(found):
        if i is None or not asks(i):
            continue
        others = [(-sum(a * b for a, b in zip(q, v, strict=True)), j is None, j or 0) for o, (j, v) in enumerate(found) if o != at]
        for rank, (score, missing, j) in enumerate(sorted(others)[:k], 1):
            out.append((i, rank, None if missing else j, -score))
    return sorted(out, key=str)


def searched(spark, rows, k=20, parts=3, kind=ROWS, **settings):
    found = exact_top_k(table(spark, rows, kind).repartition(parts), F.col("vec_id") % 5 == 0, k, **settings)
    return sorted(map(tuple, found.collect()), key=str)


SMALL = {"pivots": 4, "annulus_rows": 16, "chunk_rows": 40, "query_chunks": 2}


@pytest.mark.parametrize("settings", [{}, SMALL, {**SMALL, "pivots": 1}, {**SMALL, "sample": 3, "query_chunks": 1}])
def test_search_is_that_of_brute_force(spark, settings):
    rows = [(i, v) for i, v in enumerate(cloud(260, 6))] + ODD
    assert searched(spark, rows, 7, **settings) == brute(rows, 6, lambda i: i % 5 == 0, 7)


def test_search_among_clusters_leaves_annuli_out(spark, monkeypatch):
    draw = np.random.default_rng(5)
    centres = draw.normal(0, 3, (6, 8))
    rows = [(i, (centres[i % 6] + draw.normal(0, 0.05, 8)).astype(np.float32).tolist()) for i in range(600)]
    assert searched(spark, rows, 5, **SMALL) == brute(rows, 8, lambda i: i % 5 == 0, 5)
    written = []
    monkeypatch.setattr(top_k, "materialize", lambda df, name: written.append(df.cache()) or written[-1])
    settings = {**SMALL, "pivots": 6, "chunk_rows": 32, "query_chunks": 1}
    exact_top_k(table(spark, rows), F.col("vec_id") % 5 == 0, 5, **settings).count()
    index, met = written
    chunks = index.select("chunk").distinct().count()
    assert met.count() < 0.6 * chunks * chunks


def test_ties_copies_and_missing_ids(spark):
    rows = [(i if i % 9 else None, [0.5, 0.25, -0.25]) for i in range(90)]
    rows += [(i % 10, [0.5, 0.25, -0.25]) for i in range(40)] + [(i, v) for i, v in enumerate(cloud(50, 3))]
    for settings in ({}, SMALL):
        assert searched(spark, rows, 12, **settings) == brute(rows, 3, lambda i: i % 5 == 0, 12)


def test_one_long_vector_and_negative_ids(spark):
    rows = [(-i, v) for i, v in enumerate(cloud(120, 4))] + [(500, [900.0, -900.0, 0.0, 1.0])]
    assert searched(spark, rows, 6, **SMALL) == brute(rows, 4, lambda i: i % 5 == 0, 6)


@pytest.mark.parametrize("factor", [2.0**9, 2.0**14, 2.0**22])
def test_wide_numbers_are_exact(spark, factor):
    rows = [(i, [x * factor for x in v]) for i, v in enumerate(cloud(80, 3, spread=1))]
    kind = ROWS.replace("array<float>", "array<double>")
    assert searched(spark, rows, 6, kind=kind, **SMALL) == brute(rows, 3, lambda i: i % 5 == 0, 6)


def test_products_beyond_64_bits_end_the_search(spark):
    kind = ROWS.replace("array<float>", "array<double>")
    with pytest.raises(Exception, match="64"):
        searched(spark, [(5, [2.0**30, 1.0]), (6, [1.0, 2.0])], kind=kind)


def test_fewer_than_k_others_and_none(spark):
    rows = [(i, v) for i, v in enumerate(cloud(6, 3))]
    assert searched(spark, rows) == brute(rows, 3, lambda i: i % 5 == 0, 20)
    assert searched(spark, rows[:1]) == []
    assert searched(spark, []) == []
    assert searched(spark, ODD[:1]) == []
    assert searched(spark, rows[1:5]) == []  # nobody asks
