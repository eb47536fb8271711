import zlib

import numpy as np
import pytest

from microtally.llm import operators, quality_classifier, samples, toxicity  # noqa: F401
from microtally.llm.registry import QUERIES
from tests.llm.cases import AWKWARD, awkward, clashing, table
from pyspark.sql import functions as F

TRAIN_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled():
    import os

    from tests.llm import cases

    if not os.path.isdir(TRAIN_DIR):
        pytest.skip("needs the larger tables")
    before, cases.SF_DIR = cases.SF_DIR, TRAIN_DIR
    try:
        texts = {row["doc_id"]: row["text"] for row in table("documents")}
        return [(row["doc_id"], texts[row["doc_id"]], row["quality"], row["toxic"]) for row in table("labels")]
    finally:
        cases.SF_DIR = before


@pytest.mark.parametrize("key, column, divisor, left_out, wanted, caught", [
    ("op3_quality_classifier", 2, 4, 2, 0.97, 0.97), ("op10_toxicity", 3, 3, 1, 0.96, 0.8)])
def test_held_out_accuracy(spark, labelled, key, column, divisor, left_out, wanted, caught):
    found = {row.doc_id: row for row in QUERIES[key](spark, TRAIN_DIR).collect()}
    assert all(row.held_out == (zlib.crc32(str(doc_id).encode()) % divisor == left_out) for doc_id, row in found.items())
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7) for row in found.values())
    unseen = [(found[row[0]].predicted, row[column]) for row in labelled if found[row[0]].held_out]
    assert np.mean([guess == label for guess, label in unseen]) >= wanted
    recall = np.mean([guess for guess, label in unseen if label])
    print(key, "recall", recall, "false alarms", sum(guess for guess, label in unseen if not label), "of", len(unseen))
    assert recall >= caught


def small_model(module):
    if module is toxicity:
        return toxicity.fit_ftrl([(toxicity.text_features(text).astype(np.int64), label) for text, label in [("you loser", 1), ("good day", 0)] * 20])
    return quality_classifier.fit([(text.encode(), label) for text, label in [("$$$ ### " * 30, 0), ("a quiet day " * 20, 1)] * 20], steps=30)


@pytest.mark.parametrize("module", [toxicity, quality_classifier])
def test_awkward_rows_have_scores(spark, module):
    docs = clashing(awkward(spark))
    scored = module.score(docs, small_model(module), into="s$")
    assert scored.columns == [*docs.columns, "s$"]
    rows = scored.collect()
    assert len(rows) == len(AWKWARD) and all(0 <= row["s$"] <= 1 for row in rows)
    scores = {}
    for row in rows:
        assert scores.setdefault(row.text or "", row["s$"]) == pytest.approx(row["s$"], abs=1e-6)
    assert module.score(awkward(spark, []), small_model(module)).count() == 0


@pytest.mark.parametrize("module", [toxicity, quality_classifier])
def test_no_usable_labels(spark, module):
    docs = awkward(spark)
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    scores = [row["s$"] for row in module.score(docs, module.train(docs, labels), into="s$").collect()]
    assert len(scores) == len(AWKWARD) and all(0 <= score <= 1 for score in scores)


def test_the_sample_is_bounded_and_leaves_out_what_is_held_out(spark):
    docs = awkward(spark, [(n, f"text {n}", None, None, None) for n in range(200)])
    labels = spark.createDataFrame([(n, n % 2) for n in range(200)] + [(3, 0), (5, None)], "doc_id long, quality int")
    rows = samples.labelled_sample(docs, labels, "quality", 50, 4, 2).collect()
    assert len(rows) == 50 and all(zlib.crc32(str(row.k).encode()) % 4 != 2 for row in rows)
    everything = samples.labelled_sample(docs, labels, "quality", 500, 4, 2).collect()
    assert {row.k: row.y for row in everything} == {n: n % 2 for n in range(200) if zlib.crc32(str(n).encode()) % 4 != 2}


def test_remainder_is_that_of_the_id_as_text(spark):
    frame = spark.createDataFrame([(n,) for n in (0, 1, -5, 10**12)], "n long").select("n", samples.remainder(F.col("n"), 7).alias("r"))
    assert all(row.r == zlib.crc32(str(row.n).encode()) % 7 for row in frame.collect())


def test_chunks_cover_the_whole_text_and_overlap():
    for size in (0, 1, 255, 256, 257, 5000):
        data = bytes(n % 251 for n in range(size))
        chunks = quality_classifier.chunks_of(data.decode("latin-1").encode("ascii", "replace").decode())
        assert len(chunks) == max(1, -(-size // quality_classifier.CHUNK))
        for one, two in zip(chunks, chunks[1:]):
            assert (one[quality_classifier.CHUNK:] == two[:quality_classifier.WIDTH]).all()


def test_gradients_against_differences():
    draw = np.random.default_rng(0)
    net = {name: value.astype(np.float64) for name, value in quality_classifier.new_network(1).items()}
    parts = [draw.integers(0, 256, (n, quality_classifier.CHUNK + quality_classifier.WIDTH)).astype(np.int16) for n in (1, 3, 2)]
    chunks, starts, filled = np.concatenate(parts), np.array([0, 1, 4]), np.array([200, 700, 500])
    labels, weights = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0])

    def loss():
        best, _ = quality_classifier._strongest(net, chunks)
        chance, _ = quality_classifier._combine(net, best, starts, filled)
        return -np.mean(weights * (labels * np.log(chance) + (1 - labels) * np.log(1 - chance)))

    grad = quality_classifier._gradients(net, chunks, starts, filled, labels, weights)
    for name in ("out", "dense", "dense_bias", "filter_bias", "filters", "bytes"):
        flat, slope = net[name].reshape(-1), np.asarray(grad[name], dtype=float).reshape(-1)
        for place in np.argsort(-np.abs(slope))[:3]:
            step, kept = 1e-2, flat[place]
            flat[place] = kept + step
            up = loss()
            flat[place] = kept - step
            down = loss()
            flat[place] = kept
            assert (up - down) / (2 * step) == pytest.approx(slope[place], rel=0.15, abs=2e-4)


def test_ftrl_leaves_useless_weights_at_zero():
    draw = np.random.default_rng(2)
    examples = [(np.unique(np.append(draw.integers(10, 5000, 30), 3 if label else 4)), label) for label in draw.integers(0, 2, 400)]
    weights, bias = toxicity.fit_ftrl(examples, buckets=5000)
    assert weights[3] > 0 > weights[4] and (weights != 0).sum() < 500


def test_features_are_packed_whole():
    draw = np.random.default_rng(3)
    for size in (0, 1, 5000, 32_767, 32_768, 200_000):
        features = np.sort(draw.permutation(1 << toxicity.BITS)[:size]).astype(np.int32)
        packed = toxicity.pack_features(features)
        assert (toxicity.unpack_features(packed) == features).all() and len(packed) <= (1 << toxicity.BITS) // 8 + 1


def test_the_scale_is_that_of_the_labels():
    draw = np.random.default_rng(4)
    totals = draw.normal(size=20_000) * 8
    labels = draw.random(20_000) < 1 / (1 + np.exp(-(0.5 * totals + 1)))
    assert toxicity.fit_scale(totals, labels) == pytest.approx((0.5, 1.0), abs=0.1)
    assert toxicity.fit_scale([-30.0, 30.0] * 50, [0, 1] * 50)[0] > 0
    assert toxicity.fit_scale([1.0, 2.0], [1, 1]) == toxicity.fit_scale([], []) == (1.0, 0.0)


def test_whole_documents_are_taken_up_to_a_number_of_bytes(spark):
    frame = spark.createDataFrame([(n, n % 2, bytes(10 + n)) for n in range(40)], "k long, y int, x binary")
    everything = samples.within_bytes(frame, 10_000)
    assert [(k, len(x)) for k, _, x in everything] == sorted(((n, 10 + n) for n in range(40)), key=lambda row: str(row[0]))
    some = samples.within_bytes(frame.repartition(3), 300)
    assert 0 < sum(len(x) for _, _, x in some) <= 300 and set(some) < set(everything)
    assert some == samples.within_bytes(frame, 300) and len(samples.within_bytes(frame, 1)) == 1
    assert samples.within_bytes(frame.limit(0), 300) == []


def test_what_stands_at_the_end_of_a_long_text_is_learned_from(labelled):
    filler = "quiet words about the weather and the sea " * 2000
    examples = [(toxicity.text_features(filler + ("you vile loser" if label else "you kind friend")), label) for label in (0, 1) * 20]
    weights, bias = toxicity.fit_ftrl(examples)
    total = [bias + weights[features].sum() for features, _ in examples[:2]]
    assert total[0] < 0 < total[1]


def test_long_documents_are_right(spark, labelled):
    found = {row.doc_id: row for row in QUERIES["op3_quality_classifier"](spark, TRAIN_DIR).collect()}
    unseen = sorted((row for row in labelled if found[row[0]].held_out), key=lambda row: len(row[1] or ""))
    longest = unseen[-len(unseen) // 10:]
    assert np.mean([found[row[0]].predicted == row[2] for row in longest]) >= 0.97
