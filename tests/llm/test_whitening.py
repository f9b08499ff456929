"""Whitened components against numpy on the whole table, and odd rows."""

import numpy as np
import pytest
from clicktally.llm import whitening
from clicktally.llm.whitening import whitened

SCHEMA = "vec_id long, embedding array<float>, n long, index long, x string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7, 3, "own") for i, v in rows], SCHEMA)


def plain(rows):
    """x of each row, and n, sums, falling eigenvalues, eigenvectors and trace of the fit list."""
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    gaps = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(gaps.T @ gaps / n)
    order = np.argsort(-values)
    return x, n, sums, values[order], vectors[:, order]


def assert_whitened(found, rows, components=16):
    x, n, sums, values, vectors = plain(rows)
    k = min(components, len(values))
    wanted = (n * x - sums) / n @ vectors[:, :k] / np.sqrt(values[:k])
    deviations = ((n * x - sums).astype(object) ** 2).sum(axis=1)
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, []).append(r)
    assert sorted(by_row) == sorted({i for i, _ in rows})
    got = np.zeros_like(wanted)
    for place, (i, _) in enumerate(rows):
        own = sorted(by_row[i], key=lambda r: r.component)
        assert [r.component for r in own] == list(range(1, k + 1))
        assert {r.n for r in own} == {n} and {r.deviation for r in own} == {deviations[place]}
        assert [r.explained for r in own] == pytest.approx((values[:k] / values.sum()).tolist(), rel=1e-9)
        got[place] = [r.whitened for r in own]
    signs = np.sign((got * wanted).sum(axis=0))
    assert np.abs(got * signs - wanted).max() < 1e-8
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-9


def cloud(n, size, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, size)) @ rng.standard_normal((size, size)) + rng.standard_normal(size) * 5
    return [(i, own.astype(np.float32).tolist()) for i, own in enumerate(v)]


@pytest.mark.parametrize("size", [3, 24])
def test_against_numpy(spark, size):
    rows = cloud(300, size)
    assert_whitened(whitened(table(spark, rows)).collect(), rows)


def test_many_blocks_of_rows_and_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 7)
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", 70)
    monkeypatch.setattr(whitening, "BLOCKS_A_PART", 2)
    rows = cloud(233, 17, seed=3)
    assert_whitened(whitened(table(spark, rows), components=5).collect(), rows, components=5)


def test_copies_count_once_in_the_fit_list(spark):
    rows = cloud(60, 4, seed=1)
    copies = rows + [(1000 + i, rows[0][1]) for i in range(200)]
    assert_whitened(whitened(table(spark, copies)).collect(), copies)


def test_odd_rows(spark):
    rows = cloud(40, 4, seed=2)
    odd = [(1100, None), (1101, []), (1103, [float("nan"), 1.0, 1.0, 1.0]), (1104, [float("-inf"), 1.0, 1.0, 1.0]),
           (1105, [None, 1.0, 1.0, 1.0]), (1106, [1e30, 1.0, 1.0, 1.0]), (1107, [1.0, 2.0, 3.0, 4.0, 5.0])]
    found = whitened(table(spark, rows + odd)).collect()
    assert_whitened(found, rows)  # the only vector of five components has no variance
    unnumbered = whitened(table(spark, rows + [(None, [1.0, 2.0, 3.0, 4.0])])).filter("vec_id is null")
    assert unnumbered.count() == 4


def test_each_length_by_itself(spark):
    short, long = cloud(50, 3, seed=4), [(500 + i, v) for i, v in cloud(30, 5, seed=5)]
    found = whitened(table(spark, short + long)).collect()
    assert_whitened([r for r in found if r.vec_id < 500], short)
    assert_whitened([r for r in found if r.vec_id >= 500], long)


def test_flat_directions_and_large_numbers(spark):
    flat = [(i, [*v, v[0], 1.0]) for i, v in cloud(50, 2, seed=6)]
    assert {r.component for r in whitened(table(spark, flat)).collect()} == {1, 2}
    huge = [(i, [v[0] * 1e12, v[1]]) for i, v in cloud(50, 2, seed=7)]
    assert {r.deviation for r in whitened(table(spark, huge)).collect()} == {None}


def test_no_vectors(spark):
    assert whitened(table(spark, [])).count() == 0
    assert whitened(table(spark, [(1, None), (2, [])])).count() == 0
    assert whitened(table(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
