import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from microtally.llm import byte_bpe, mixing, quality_classifier, quality_rules, simhash
from tests.llm.cases import SF_DIR, awkward


def test_stages_and_registration():
    from __spark_entry__ import oracle_sql, queries

    assert [stage.__name__ for _, stage in corpus_pipeline.STAGES] == ["keep_good", "keep_by_rules", "keep_one_of_each", "mix", "encode"]
    assert "pipeline" in queries() and "pipeline" not in oracle_sql()
    assert {f"op{n}" for n in range(1, 14)} <= {key.split("_")[0] for key in queries()}


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage has kept, on the smallest tables."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(place))
        stage(spark, docs, SF_DIR).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_stages_keep_the_columns_of_documents(spark, steps):
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").dtypes
    assert all(after.dtypes == columns for _, after in steps[:-1])


def test_decisions_take_effect(spark, steps):
    (docs, good), (_, ruled), (_, single), (_, mixed), (_, tokens) = steps
    net = quality_classifier.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    scores = {row.doc_id: row.quality for row in quality_classifier.score(docs, net).collect()}
    ids = lambda frame: sorted(row.doc_id for row in frame.collect())
    assert ids(good) == sorted(doc_id for doc_id, score in scores.items() if score >= quality_classifier.THRESHOLD)
    assert ids(ruled) == ids(quality_rules.quality_cascade(good).filter("quality.kept"))
    groups = simhash.near_duplicates(ruled)
    assert ids(single) == sorted(row.component_id for row in groups.select("component_id").distinct().collect())
    plan = mixing.plan_mix(single)
    used = Counter({row.doc_id: row.n for row in plan.select("doc_id", F.size("passes").alias("n")).collect() if row.n})
    assert Counter(ids(mixed)) == used
    assert Counter(ids(tokens)) == used


def test_tokens_are_those_of_the_mixed_texts(steps):
    mixed, tokens = steps[-1]
    wanted = Counter((row.doc_id, hashlib.sha256(row.text.encode()).hexdigest()) for row in mixed.collect())
    assert Counter((row.doc_id, row.decoded_sha256) for row in tokens.collect()) == wanted
    assert all(row.n_tokens == len(row.ids) for row in tokens.collect())


def test_run_gives_the_same_rows(spark, steps):
    found = corpus_pipeline.run(spark, SF_DIR)
    rows = lambda frame: Counter((row.doc_id, row.n_tokens, row.decoded_sha256) for row in frame.collect())
    assert rows(found) == rows(steps[-1][1])


def test_awkward_documents_go_through_every_stage(spark):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (awkward(spark), awkward(spark, [])):
            assert stage(spark, docs, SF_DIR).count() <= 2 * docs.count()
    assert byte_bpe.VOCABULARY.endswith(".tiktoken")


def test_mixing_uses_whole_documents(spark):
    texts = ["one  two\nthree " * (n + 1) for n in range(40)]
    docs = awkward(spark, [(n, text, "en", "ab"[n % 2], len(text)) for n, text in enumerate(texts)])
    plan = mixing.plan_mix(docs).collect()
    assert any(item.words < row["size"] for row in plan for item in row.passes)
    mixed = corpus_pipeline.mix(spark, docs, SF_DIR).collect()
    assert Counter(row.doc_id for row in mixed) == Counter(row.doc_id for row in plan for _ in row.passes)
    assert all(row.text == texts[row.doc_id] and row.n_chars == len(row.text) for row in mixed)


def test_the_training_order_survives_reading(spark, tmp_path):
    """Written as many files and read in another order, the tokens sorted by their place are the plan."""
    texts = ["some words " * (1 + n % 37) for n in range(900)]
    docs = awkward(spark, [(n, text, "en", "abc"[n % 3], len(text)) for n, text in enumerate(texts)], 9)
    path = str(tmp_path / "mixed")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        corpus_pipeline.mix(spark, docs, SF_DIR).write.option("maxRecordsPerFile", 10**9).parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [name for name in (tmp_path / "mixed").iterdir() if name.name.startswith("part-")]
    assert len(files) >= 8
    tokens = corpus_pipeline.encode(spark, spark.read.parquet(path), SF_DIR)
    plan = sorted((item.position, str(row.doc_id)) for row in mixing.plan_mix(docs).collect() for item in row.passes)
    assert [str(row.doc_id) for row in tokens.orderBy("shard", "block", "row").collect()] == [doc_id for _, doc_id in plan]
