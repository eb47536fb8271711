import math

import numpy as np
import pytest

from microtally.llm import embedding_dedup, operators  # noqa: F401
from microtally.llm.hnsw import Graph
from microtally.llm.registry import QUERIES
from tests.llm.cases import SF_DIR, components, table

SCHEMA = "vec_id long, embedding array<float>, label int"


def cosine(a, b):
    if len(a) != len(b):
        return 0.0
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def expected(rows):
    nodes = range(len(rows))
    fine = [n for n in nodes if usable(rows[n][1])]
    pairs = [(a, b) for a in fine for b in fine if a < b and cosine(rows[a][1], rows[b][1]) >= 0.9]
    group, links = components(nodes, pairs), [0] * len(rows)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    ids = {}
    for n in nodes:
        if rows[n][0] is not None:
            ids[group[n]] = min(rows[n][0], ids.get(group[n], rows[n][0]))
    out = [(rows[n][0], links[n], ids.get(group[n])) for n in nodes]
    return sorted(repr((*row, row[0] is not None and row[0] == row[2])) for row in out)


def clustered(count=600, dims=16, seed=4):
    """Unit vectors, some in tight groups of different sizes."""
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, dims))
    rows = [draw.standard_normal(dims) for _ in range(count // 2)]
    for n in range(count - len(rows)):
        rows.append(centres[int(12 * draw.random() ** 3)] + 0.15 * draw.standard_normal(dims))
    return [(n, [float(np.float32(x)) for x in rows[n]], 0) for n in range(count)]


def found(frame):
    return sorted(repr(tuple(row)) for row in frame.select("vec_id", "n_links", "component_id", "kept").collect())


def test_whole_table(spark):
    rows = [(row["vec_id"], row["embedding"]) for row in table("embeddings")]
    assert found(QUERIES["op2_embedding_dedup"](spark, SF_DIR)) == expected(rows)


def test_groups_are_found(spark):
    rows = clustered()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(embedding_dedup.near_duplicate_vectors(frame)) == expected(rows)


def test_awkward_rows(spark):
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (None, [1.0, 0.1], 2), (3, [0.0, 0.0], 0), (4, None, 0), (5, [], 0),
        (6, [1.0, None], 0), (7, [float("nan"), 1.0], 0), (8, [float("inf"), 1.0], 0), (9, [1.0], 0), (10, [3e38, 3e38], 0),
        (11, [1e-30, 1e-30], 0), (None, [-1.0, 0.0], 0), (None, None, None), (12, [1.0, 0.0, 0.0], 0), (13, [-0.0, 5.0], 0)]
    frame = spark.createDataFrame([(*row, 1, 2) for row in rows], SCHEMA + ", unit int, n_links int")
    assert found(embedding_dedup.near_duplicate_vectors(frame)) == expected(rows)


def test_empty_table(spark):
    assert embedding_dedup.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_of_the_graph_against_brute_force():
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((60, 24))
    vectors = np.concatenate([draw.standard_normal((2500, 24)), np.repeat(centres, 25, axis=0) + 0.2 * draw.standard_normal((1500, 24))])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = Graph.build(vectors)
    true = {(a, b) for a, b in zip(*np.nonzero(vectors @ vectors.T >= 0.9))}
    a, b = graph.within(vectors, 0.9, embedding_dedup.BEAM)
    got = {(x, y) for x, y in zip(a, b) if vectors[x] @ vectors[y] >= 0.9}
    assert got <= true and len(got) >= 0.97 * len(true)
    again = Graph.from_rows(vectors, *graph.rows())
    assert np.array_equal(again.layers[0].links, graph.layers[0].links)


def test_beams_widen_until_the_audit_passes(monkeypatch):
    rows = np.array([row[1] for row in clustered(400)])
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    graph = Graph.build(units)
    tried = []
    within = graph.within
    monkeypatch.setattr(graph, "within", lambda queries, least, beam: (tried.append(beam), tuple(x[:0] for x in within(queries, least, beam)))[1])
    a, _, audit = embedding_dedup.linked(graph, units, units, beam=24)
    assert tried == [24, 48, 96, 192, 384] and audit[0] == len(units)
    assert len(a) == int((units @ units.T >= 0.9).sum())


@pytest.mark.parametrize("vector", [None, [], [0.0], [None], [float("nan")], [float("-inf"), 1.0]])
def test_vectors_without_direction(vector):
    assert embedding_dedup.unit_vector(vector) is None
