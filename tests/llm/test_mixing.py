from collections import Counter, defaultdict

import pytest

from microtally.llm import mixing, operators  # noqa: F401
from microtally.llm.registry import ORACLES, QUERIES
from tests.llm.cases import SF_DIR, awkward, clashing, same_as_sql, tables
from workload.check import compare, connect


def shared_out(sizes, weights, share, most):
    """Targets by handing out shares again and again until no source is above its limit."""
    target, full = {}, set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(weights[s] for s in sizes if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weights[s] / total for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 5, "c": 1000, "d": 3}, {"a": 0, "b": 7}])
def test_targets_are_shared_out_until_none_is_above(spark, sizes):
    weights = dict(zip(sorted(sizes), [5, 2, 1, 5, 2]))
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {row.source: row.target for row in mixing.source_targets(frame).collect()}
    assert found == pytest.approx(shared_out(sizes, weights, 1.5, 2))


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF_DIR), QUERIES["op1_mix_sources"], ORACLES["op1_mix_sources"], SF_DIR) is None


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op1_mix_sources"](spark, str(tmp_path))
    same_as_sql(found, tables({"documents": docs}), ORACLES["op1_mix_sources"])
    assert sorted(map(repr, found.collect())) == sorted(map(repr, QUERIES["op1_mix_sources"](spark, str(tmp_path)).collect()))


def test_taken_words_meet_the_targets(spark):
    plan = mixing.plan_mix(clashing(awkward(spark))).collect()
    taken, target = defaultdict(int), {}
    for row in plan:
        assert 0 <= row.taken <= 2 * row["size"]
        taken[row.source] += row.taken
        target[row.source] = row.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_empty_table(spark):
    docs = awkward(spark, [])
    assert mixing.plan_mix(docs).count() == 0 and mixing.mixed_documents(docs).columns == docs.columns


def test_documents_stand_whole_in_the_order_of_their_positions(spark):
    docs = clashing(awkward(spark))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.dtypes == docs.dtypes
    rows = mixed.collect()
    plan = [(item["position"], row.doc_id) for row in mixing.plan_mix(docs).collect() for item in row.passes]
    texts = {(row.doc_id, row.text) for row in docs.collect()}
    assert all((row.doc_id, row.text) in texts for row in rows)
    plan.sort(key=lambda item: (item[0], "" if item[1] is None else str(item[1])))
    assert [row.doc_id for row in rows] == [doc_id for _, doc_id in plan]


def test_a_third_without_ids(spark):
    rows = [(None if number % 3 == 0 else number, f"w{number} " * (3 + number % 2), None, "ab"[number % 2], 9) for number in range(90)]
    docs = awkward(spark, rows, 4)
    plan = mixing.plan_mix(docs).collect()
    used = Counter((row.doc_id, row["size"]) for row in plan for _ in row.passes)
    mixed = Counter((row.doc_id, len(row.text.split())) for row in mixing.mixed_documents(docs).collect())
    assert mixed == used and sum(row.taken for row in plan) > 0
    once = Counter(row.text for row in mixing.mixed_documents(docs).collect())
    assert max(once.values()) <= 2


def test_the_schedule_decides_the_positions_of_the_query(spark):
    """With flat schedules the compared rows differ, so the comparison with SQL covers the curriculum."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    places = lambda plan: sorted(str(row.passes[0].position) for row in plan.collect() if row.passes)
    assert places(mixing.plan_mix(docs)) != places(mixing.plan_mix(docs, ramps=(0,)))


def test_a_schedule_uses_words_early_or_late(spark):
    rows = [(number, "w " * 10, None, source, 20) for number in range(200) for source in "abc"]
    rows = [(place, *row[1:]) for place, row in enumerate(rows)]
    plan = mixing.plan_mix(awkward(spark, rows)).collect()
    middle = {}
    for source in "abc":
        places = [item["position"] for row in plan if row.source == source for item in row.passes]
        middle[source] = sum(places) / len(places)
    assert middle["a"] > middle["b"] > middle["c"]  # ramps 0.6, 0, -0.6
