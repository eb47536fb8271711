"""Toxicity by logistic regression on hashed word features, fitted with FTRL-proximal.

A text is lower-cased and cut into words; its features are hashes of words, of word beginnings
(so that endings do not hide a word), of pairs of neighbours and of pairs with one word between
them. A feature counts once, however often it occurs. FTRL-proximal gives every weight its own
learning rate and, by its L1 term, leaves most weights at exactly zero; what is left is a short
list of weights, whose size the number of buckets bounds, and is sent to all tasks.

Fitting and scoring both use all features of a text. The loss of whole texts leaves raw scores unsure of rare
words, so a part of the sample is scored by a model of the rest, and a slope and an offset fitted to these
scores (Platt scaling) turn the sum of weights into a probability.

Scores are computed inside tasks on Arrow batches, over whole texts.

Defined results
    null and empty texts: no features, the score of the bias. Repeated rows: scored one by one.
    Empty table: no rows. No usable labels: all weights zero, score 0.5 everywhere. Only the text is
    looked at; the other columns are kept, whatever their names.
"""

from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from microtally.llm.registry import in_batches, query, read
from microtally.llm.samples import labelled_sample, remainder, within_bytes

# Fixed values of the task: rows held out from learning, and the score from which a text is toxic.
DIVISOR, HELD_OUT = 3, 1
THRESHOLD = 0.7

# The model is fitted on at most so many labelled documents, and on whole ones up to so many bytes of features
# (four a feature, never more than a bit a bucket).
SAMPLE_ROWS = 9000
SAMPLE_BYTES = 256 << 20
# One sampled document in so many is scored by a model of the rest to calibrate.
ASIDE = 3

BITS = 20
STEMS = (4, 6)
# A document is visited 6 times at least, and as often as makes VISITS visits, 40 times at most.
VISITS, LEAST_EPOCHS, MOST_EPOCHS = 50_000, 6, 40
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 1.0
BATCH_ROWS = 256

# Bytes that part words become a blank, A-Z become a-z.
_TABLE = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in range(256))


def _mix(values, salt):
    """Buckets of 64-bit values; each kind of feature has its own salt."""
    mixed = (values + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int32)


def text_features(text):
    """Distinct feature buckets of a text, sorted."""
    words = text.encode("utf-8", "replace").translate(_TABLE).split() if text else []
    if not words:
        return np.empty(0, dtype=np.int32)
    hashes = np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))
    found = [_mix(hashes, 1)]
    if len(words) > 1:
        found.append(_mix(hashes[:-1] * np.uint64(0x100000001B3) + hashes[1:], 2))
    if len(words) > 2:
        found.append(_mix(hashes[:-2] * np.uint64(0x1000193) + hashes[2:], 3))
    for salt, length in enumerate(STEMS, 4):
        stems = {word[:length] for word in words if len(word) > length}
        if stems:
            found.append(_mix(np.fromiter(map(crc32, stems), dtype=np.uint64, count=len(stems)), salt))
    return np.unique(np.concatenate(found))


def _probability(total):
    return 1.0 / (1.0 + np.exp(-np.clip(total, -35.0, 35.0)))


def fit_ftrl(examples, buckets=1 << BITS, epochs=None, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
    """Weights and bias from ``(features, label)`` pairs, visited in a fixed order."""
    z, n = np.zeros(buckets + 1), np.zeros(buckets + 1)
    epochs = epochs or min(max(VISITS // max(len(examples), 1), LEAST_EPOCHS), MOST_EPOCHS)

    def weights(at):
        pull = np.abs(z[at]) - l1
        return np.where(pull > 0, -np.sign(z[at]) * pull / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    for epoch in range(epochs):
        for place in np.random.default_rng(epoch).permutation(len(examples)):
            features, label = examples[place]
            at = np.append(features, buckets)
            w = weights(at)
            gradient = _probability(w.sum()) - label
            squared = gradient * gradient
            sigma = (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / alpha
            z[at] += gradient - sigma * w
            n[at] += squared
    everything = weights(np.arange(buckets + 1))
    return everything[:-1].astype(np.float32), float(everything[-1])


def pack_features(features, bits=BITS):
    """Sorted buckets as bytes: their numbers, or one bit a bucket where that is shorter."""
    if 32 * len(features) < 1 << bits:
        return features.astype(np.int32).tobytes() + b"n"
    flags = np.zeros(1 << bits, dtype=bool)
    flags[features] = True
    return np.packbits(flags).tobytes() + b"b"


def unpack_features(packed):
    """Buckets of ``pack_features``."""
    if packed.endswith(b"n"):
        return np.frombuffer(packed, dtype=np.int32, count=len(packed) // 4)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, dtype=np.uint8, count=len(packed) - 1))).astype(np.int32)


def fit_scale(totals, labels, steps=50):
    """Slope and offset of a logistic curve through sums of weights, by Newton's method with smoothed labels."""
    totals, labels = np.asarray(totals, dtype=float), np.asarray(labels, dtype=float)
    ones = labels.sum()
    zeros = len(labels) - ones
    if not ones or not zeros:
        return 1.0, 0.0
    wanted = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([totals, np.ones(len(totals))], axis=1)

    def loss(at):
        values = x @ at
        return np.logaddexp(0, values).sum() - wanted @ values

    at = np.array([1.0, 0.0])
    for _ in range(steps):
        chance = _probability(x @ at)
        bend = (x * (chance * (1 - chance))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(bend, x.T @ (chance - wanted))
        while loss(at - move) > loss(at) and np.abs(move).max() > 1e-9:
            move = move / 2
        at = at - move
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def fit_calibrated(examples, buckets=1 << BITS):
    """Weights and bias of all examples, scaled by the curve that scores of unseen examples ask for."""
    weights, bias = fit_ftrl([example for place, example in enumerate(examples) if place % ASIDE], buckets)
    totals = [bias + weights[features].sum(dtype=np.float64) for features, _ in examples[::ASIDE]]
    slope, offset = fit_scale(totals, [label for _, label in examples[::ASIDE]])
    weights, bias = fit_ftrl(examples, buckets)
    return (weights * slope).astype(np.float32), bias * slope + offset


def train(docs, labels, label="toxic", id="doc_id", text="text", rows=SAMPLE_ROWS, divisor=DIVISOR, held_out=HELD_OUT):
    """Fits the weights on a bounded sample of whole documents. Features are made inside tasks; the driver gets buckets."""
    in_batches(docs.sparkSession, BATCH_ROWS)

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([pack_features(text_features(each)) for each in texts])

    sample = labelled_sample(docs, labels, label, rows, divisor, held_out, id, text)
    found = within_bytes(sample.select("k", "y", features("text").alias("x")), SAMPLE_BYTES)
    order = np.random.default_rng(0).permutation(len(found))
    return fit_calibrated([(unpack_features(found[place][2]), found[place][1]) for place in order])


def score(docs, model, text="text", into="toxicity"):
    """The rows of ``docs`` with the probability that they are toxic."""
    spark = docs.sparkSession
    in_batches(spark, BATCH_ROWS)
    weights, bias = model
    used = np.flatnonzero(weights)
    sent = spark.sparkContext.broadcast((used.astype(np.int32), weights[used], bias, len(weights)))

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        places, values, start, size = sent.value
        dense = np.zeros(size, dtype=np.float32)
        dense[places] = values
        return pd.Series([float(_probability(start + dense[text_features(each)].sum(dtype=np.float64))) for each in texts], dtype="float64")

    return docs.select(*[F.col(f"`{name}`") for name in docs.columns], probability(F.col(text)).alias(into))


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    """All documents with their toxicity score."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), DIVISOR) == HELD_OUT).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
