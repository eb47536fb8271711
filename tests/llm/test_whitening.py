"""Whitening: against the eigenvectors of the covariance matrix, and on awkward vectors."""

import numpy as np
import pytest

from microtally.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def whitened(spark, vectors, **options):
    rows = [(number, None if v is None else [float(x) if x is not None else None for x in v], 0) for number, v in enumerate(vectors)]
    return whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)


def against_plain(found, vectors, scale=64, components=32):
    found = found.toPandas()
    x = np.floor(scale * np.array(vectors)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    over = n * x.astype(object) - sums
    centred = over.astype(float) / n
    covariance = centred.T @ centred / n
    values, turned = np.linalg.eigh(covariance)
    values, turned = values[::-1], turned[:, ::-1]
    kept = min(components, x.shape[1])
    assert len(found) == n * kept and set(found["n"]) == {n}
    wide = found.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    assert [int(each) for each in found[found.component == 1].sort_values("vec_id").deviation] == [int(each) for each in (over * over).sum(1)]
    explained = found[found.vec_id == 0].sort_values("component").explained.to_numpy()
    assert np.allclose(explained, values[:kept] / values.sum(), rtol=1e-10, atol=1e-14)
    return wide, centred, values[:kept], turned[:, :kept]


@pytest.mark.parametrize("rows, width", [(200, 5), (40, 33), (300, 1), (90, 64)])
def test_components_are_eigenvectors(spark, rows, width):
    random = np.random.default_rng(rows)
    vectors = random.standard_normal((rows, width)) * np.geomspace(1, 200, width) @ np.linalg.qr(random.standard_normal((width, width)))[0]
    found = whitened(spark, vectors)
    wide, centred, values, turned = against_plain(found, vectors)
    assert np.allclose(np.abs(wide), np.abs(centred @ turned / np.sqrt(values)), atol=1e-8)
    assert found.first().identity_error < 1e-9


def test_repeated_eigenvalues_are_all_found(spark):
    corners = [[a, b, c, d] for a in (0, 1) for b in (0, 1) for c in (0, 1) for d in (0, 1)]
    wide, _, values, _ = against_plain(whitened(spark, corners), corners)
    assert np.allclose(values, values[0])
    assert np.allclose(np.cov(wide.T, bias=True), np.eye(4), atol=1e-12)


def test_dimensions_without_variance(spark):
    random = np.random.default_rng(1)
    part = random.integers(-50, 50, (60, 2)) / 64
    vectors = np.column_stack([part, part.sum(1), np.full(60, 0.5)])
    found = whitened(spark, vectors).toPandas()
    wide = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy(dtype=float)
    assert np.isnan(wide[:, 2:]).all() and np.allclose(np.cov(wide[:, :2].T, bias=True), np.eye(2), atol=1e-10)
    assert found.identity_error.max() < 1e-9 and set(found[found.component > 2].explained) == {0.0}


def test_a_single_vector_and_equal_vectors(spark):
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 5):
        found = whitened(spark, vectors).collect()
        assert len(found) == 2 * len(vectors)
        assert all(row.whitened is None and row.explained is None and row.deviation == 0 and row.identity_error == 0 for row in found)


def test_unusable_and_short_vectors(spark):
    vectors = [[0.1, 0.2, 0.3], None, [0.4, None, 0.1], [float("nan"), 1, 1], [float("inf"), 1, 1], [0.5, 0.1], [], [0.1, 0.2, 0.3], [0.9, -0.4, 0.2], [1.0, 0.3, -2.0]]
    found = whitened(spark, vectors)
    assert {row.vec_id for row in found.collect()} == {0, 5, 6, 7, 8, 9}
    plain = [[0.1, 0.2, 0.3], [0.5, 0.1, 0], [0, 0, 0], [0.1, 0.2, 0.3], [0.9, -0.4, 0.2], [1.0, 0.3, -2.0]]
    numbered = found.withColumnRenamed("vec_id", "old").toPandas()
    numbered["vec_id"] = numbered.old.map({0: 0, 5: 1, 6: 2, 7: 3, 8: 4, 9: 5})
    import types

    against_plain(types.SimpleNamespace(toPandas=lambda: numbered), plain)


def test_large_numbers_are_exact(spark):
    vectors = [[2.0**40, 1.0], [-(2.0**41), 0.5], [3.0, 7.0], [1e300, -1e300]]
    found = {row.vec_id: row.deviation for row in whitened(spark, vectors).filter("component = 1").collect()}
    x = [[min(max(int(64 * c), -(2**53)), 2**53) for c in v] for v in vectors]
    sums = [sum(column) for column in zip(*x)]
    assert {number: int(total) for number, total in found.items()} == {number: sum((4 * c - s) ** 2 for c, s in zip(row, sums)) for number, row in enumerate(x)}


def test_empty_tables_and_clashing_names(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitened(spark, [[], None, []]).collect() == []
    rows = [(None, [1.0, 2.0], 1, 2, 3), (7, [2.0, 1.0], 1, 2, 3), (7, [2.0, 1.0], 1, 2, 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, cells int, component int")
    assert sorted(map(str, [row.vec_id for row in whitening.whiten(frame).collect()])) == ["7"] * 4 + ["None"] * 2


def test_sums_are_gathered_in_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    random = np.random.default_rng(4)
    vectors = random.standard_normal((50, 3))
    wide, centred, values, turned = against_plain(whitened(spark, vectors), vectors)
    assert np.allclose(np.abs(wide), np.abs(centred @ turned / np.sqrt(values)), atol=1e-9)
