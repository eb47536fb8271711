"""Nearest neighbours: recall and scores against brute force, and awkward vectors."""

import numpy as np
from pyspark.sql import functions as F

from microtally.llm import nearest
from tests.llm.cases import SF_DIR, table

SCHEMA = "vec_id long, embedding array<double>, label int"


def searched(spark, rows, every=20, **options):
    frame = spark.createDataFrame([(id, v, 0) for id, v in rows], SCHEMA).repartition(3)
    found = {}
    for row in nearest.nearest(frame, F.col("vec_id") % every == 0, **options).orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    return found


def exact(rows, every=20, neighbours=20):
    """The nearest rows of each query by plain comparison; ids are unique."""
    usable = [(id, np.array(v, float)) for id, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for id, v in usable:
        if id is not None and id % every == 0:
            others = [(-float(v @ w), other is None, other or 0, other) for other, w in usable if other != id and len(w) == len(v)]
            out[id] = [(place + 1, other, -less) for place, (less, _, _, other) in enumerate(sorted(others, key=lambda each: each[:3])[:neighbours])]
    return {id: best for id, best in out.items() if best}


def close(found, wanted):
    assert set(found) == set(wanted)
    for id in wanted:
        assert [row[:2] for row in found[id]] == [row[:2] for row in wanted[id]], id
        assert np.allclose([row[2] for row in found[id]], [row[2] for row in wanted[id]], rtol=1e-12)


def test_recall_and_scores_on_a_whole_table(spark):
    rows = [(row["vec_id"], row["embedding"]) for row in table("embeddings")]
    wanted, found = exact(rows), {}
    for row in nearest.op13_nearest_neighbours(spark, SF_DIR).orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    assert set(found) == set(wanted)
    hits = sum(len({row[1] for row in found[id]} & {row[1] for row in wanted[id]}) for id in wanted)
    assert hits >= 0.93 * sum(map(len, wanted.values()))
    vectors = {id: np.array(v, float) for id, v in rows}
    for id, best in found.items():
        assert [row[0] for row in best] == list(range(1, len(best) + 1))
        assert all(score == np.einsum("i,i->", vectors[id], vectors[other]) or np.isclose(score, vectors[id] @ vectors[other], rtol=1e-13) for _, other, score in best)
        assert [row[2] for row in best] == sorted((row[2] for row in best), reverse=True)


def clustered(count, width=32, seed=2):
    random = np.random.default_rng(seed)
    middles = random.standard_normal((40, width)) * 3
    return [(number, (middles[number % 40] + 0.3 * random.standard_normal(width)).tolist()) for number in range(count)]


def test_clusters_probe_few_lists(spark, monkeypatch):
    probes = []
    audited = nearest.Index._audited
    monkeypatch.setattr(nearest.Index, "_audited", lambda *given: probes.append(audited(*given)) or probes[-1])
    monkeypatch.setattr(nearest, "SHELF_ROWS", 100)
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 16)
    rows = clustered(3_000)
    found, wanted = searched(spark, rows), exact(rows)
    hits = sum(len({row[1] for row in found[id]} & {row[1] for row in wanted[id]}) for id in wanted)
    assert probes[0] <= 20 and hits >= 0.95 * sum(map(len, wanted.values()))


def test_tests_abandon_candidates_and_keep_neighbours():
    random = np.random.default_rng(0)
    middles = random.standard_normal((30, 128)) * 2
    vectors = (middles[np.arange(3_000) % 30] + 0.4 * random.standard_normal((3_000, 128)))
    turn = np.linalg.qr(random.standard_normal((128, 128)))[0]
    turned = nearest.Turned((vectors @ turn).astype(np.float32))
    queries = np.arange(60)
    scores = vectors[queries] @ vectors.T
    threshold = np.sort(scores, axis=1)[:, -21]
    a, b = nearest.survivors(turned, queries, turned, np.arange(3_000), threshold)
    kept = np.zeros(scores.shape, bool)
    kept[a, b] = True
    true = scores >= threshold[:, None]
    assert kept[true].mean() > 0.99 and kept.mean() < 0.05


def test_equal_vectors_ties_and_own_rows(spark):
    rows = [(number, [1.0, 0.0]) for number in range(70)] + [(100 + number, [1.0, 5.0]) for number in range(4)]
    close(searched(spark, rows, recall=1.0), exact(rows))


def test_repeated_ids_and_null_ids(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (None, [1.0, 2.0]), (3, [1.0, 1.0])]
    found = searched(spark, rows)
    assert sorted(found[0]) == [(1, 0, 5.0), (1, 0, 5.0), (2, None, 5.0), (2, None, 5.0), (3, 3, 3.0), (3, 3, 3.0)]


def test_unusable_vectors_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, -0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [3.0, 1.0]), (20, [1.0, 1.0, 1.0]),
            (21, [2.0, 1.0, 1.0]), (40, [0.0, 5.0]), (60, None), (80, [0.0, 0.0]), (100, [1.0] * 5), (-20, [2.0, 2.0])]
    close(searched(spark, rows, recall=1.0), exact(rows))


def test_very_large_numbers_do_not_crash(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, -1.0]), (2, [1.0, 1.0]), (20, [1e-300, 1.0]), (3, [-1e38, 1e38])]
    found = searched(spark, rows, recall=1.0)
    assert {id: len(best) for id, best in found.items()} == {0: 4, 20: 4}


def test_empty_table_and_clashing_names(spark):
    assert nearest.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []
    frame = spark.createDataFrame([(0, [1.0], 1, 2, 3), (1, [2.0], 1, 2, 3)], "vec_id long, embedding array<float>, id int, cells int, node int")
    assert [tuple(row) for row in nearest.nearest(frame, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2.0)]
    assert nearest.nearest(frame, F.lit(None).cast("boolean")).collect() == []
