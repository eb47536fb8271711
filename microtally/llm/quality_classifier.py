"""Quality classifier: a convolutional network on bytes, in numpy.

Each byte has a small learned vector. A text is cut into chunks of bytes that overlap by one window,
so that no window is lost, over its whole length; learned filters slide over a chunk, and the
strongest response of each filter in the chunk is kept. The chunks of a text are combined by the
mean and the maximum of these responses, and two dense layers turn them, with the number of bytes,
into one probability.

The network is fitted on the driver with Adam on a bounded sample; its 20,000 numbers are sent to
all tasks. Scores are computed in tasks on Arrow batches, a few hundred chunks at a time, so the
length of a text costs time, not memory.

Defined results
    null and empty texts: one chunk of padding, scored like any other. Repeated rows: scored one by
    one, alike. Empty table: no rows. No usable labels: a constant score. Only the text is looked at;
    the other columns are kept, whatever their names.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from microtally.llm.registry import in_batches, query, read
from microtally.llm.samples import labelled_sample, remainder, within_bytes

# Fixed values of the task: rows held out from learning, and the score from which a text is good.
DIVISOR, HELD_OUT = 4, 2
THRESHOLD = 0.7

# The network is fitted on at most so many labelled documents, and on whole ones up to so many bytes of text.
# Fitting and scores both look at all chunks of a text.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 128 << 20

CHUNK, WIDTH, STRIDE = 256, 8, 4
DIMENSIONS, FILTERS, HIDDEN = 8, 64, 24
PAD = 256
STEPS, BATCH, RATE, RARE = 960, 16, 0.006, 2.0
WINDOWS = CHUNK // STRIDE + 1
BLOCK = 256
BATCH_ROWS = 256


def chunks_of(text):
    """A text, or its bytes, as rows of byte numbers; neighbours share ``WIDTH`` bytes, the last row is padded."""
    content = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    data = np.frombuffer(content, dtype=np.uint8)
    count = max(1, -(-len(data) // CHUNK))
    padded = np.full(count * CHUNK + WIDTH, PAD, dtype=np.int16)
    padded[:len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK + WIDTH)[::CHUNK]


def new_network(seed=7):
    """Untrained parameters."""
    draw = np.random.default_rng(seed).standard_normal
    shapes = {
        "bytes": ((PAD + 1, DIMENSIONS), 0.5), "filters": ((WIDTH * DIMENSIONS, FILTERS), (WIDTH * DIMENSIONS) ** -0.5),
        "filter_bias": ((FILTERS,), 0.0), "dense": ((2 * FILTERS + 1, HIDDEN), (2 * FILTERS) ** -0.5),
        "dense_bias": ((HIDDEN,), 0.0), "out": ((HIDDEN,), HIDDEN ** -0.5), "out_bias": ((1,), 0.0),
    }
    return {name: (draw(shape) * scale).astype(np.float32) for name, (shape, scale) in shapes.items()}


def _windows(net, chunks):
    """All windows of all chunks as rows of ``WIDTH * DIMENSIONS`` numbers."""
    vectors = net["bytes"][chunks]
    view = np.lib.stride_tricks.sliding_window_view(vectors.reshape(len(chunks), -1), WIDTH * DIMENSIONS, axis=1)
    return view[:, ::STRIDE * DIMENSIONS]


def _strongest(net, chunks, places=False):
    """Strongest response of every filter in every chunk, before the bias, and where it is."""
    best, where = np.empty((len(chunks), FILTERS), np.float32), np.empty((len(chunks), FILTERS), np.int64)
    for start in range(0, len(chunks), BLOCK):
        block = _windows(net, chunks[start:start + BLOCK])
        rows = len(block)
        answers = (block.reshape(rows * WINDOWS, -1) @ net["filters"]).reshape(rows, WINDOWS, FILTERS)
        best[start:start + rows] = answers.max(axis=1)
        if places:
            where[start:start + rows] = answers.argmax(axis=1)
    return best, where


def _combine(net, best, starts, filled):
    """Probabilities of texts whose chunks begin at ``starts`` and that have ``filled`` bytes, and what is needed to learn."""
    active = np.maximum(best + net["filter_bias"], 0)
    counts = np.diff(np.append(starts, len(best)))[:, None]
    mean = np.add.reduceat(active, starts, axis=0) / counts
    top = np.maximum.reduceat(active, starts, axis=0)
    features = np.concatenate([mean, top, 1 / np.sqrt(1 + filled[:, None] / 32)], axis=1).astype(np.float32)
    hidden = np.maximum(features @ net["dense"] + net["dense_bias"], 0)
    total = hidden @ net["out"] + net["out_bias"][0]
    return 1 / (1 + np.exp(-np.clip(total, -30, 30))), (active, counts, features, hidden)


def probabilities(net, texts):
    """Probability of each text, over all its chunks."""
    parts = [chunks_of(text) for text in texts]
    best = np.concatenate([_strongest(net, part)[0] for part in _gathered(parts)]) if parts else np.empty((0, FILTERS))
    if not parts:
        return np.empty(0)
    starts = np.cumsum([0, *map(len, parts[:-1])])
    return _combine(net, best, starts, np.array([_filled(part) for part in parts]))[0].astype(float)


def _filled(chunks):
    """Bytes of a text from its chunks."""
    return (len(chunks) - 1) * CHUNK + int((chunks[-1][:CHUNK] != PAD).sum())


def _gathered(parts, limit=4 * BLOCK):
    """Chunks of neighbouring short texts together, those of a long text by themselves."""
    held, size = [], 0
    for part in parts:
        if held and size + len(part) > limit:
            yield np.concatenate(held)
            held, size = [], 0
        held.append(part)
        size += len(part)
    if held:
        yield held[0] if len(held) == 1 else np.concatenate(held)


def _gradients(net, chunks, starts, filled, labels, weights):
    best, where = _strongest(net, chunks, places=True)
    chance, (active, counts, features, hidden) = _combine(net, best, starts, filled)
    d_total = ((chance - labels) * weights / len(labels)).astype(np.float32)
    grad = {"out": hidden.T @ d_total, "out_bias": d_total.sum(keepdims=True)}
    d_hidden = np.outer(d_total, net["out"]) * (hidden > 0)
    grad["dense"], grad["dense_bias"] = features.T @ d_hidden, d_hidden.sum(axis=0)
    d_features = d_hidden @ net["dense"].T
    text_of = np.repeat(np.arange(len(starts)), counts[:, 0])
    top = slice(FILTERS, 2 * FILTERS)
    d_active = (d_features[:, :FILTERS] / counts)[text_of] + d_features[text_of, top] * (active == features[text_of, top])
    d_best = d_active * (active > 0)
    grad["filter_bias"] = d_best.sum(axis=0)
    # Only the strongest window of a filter in a chunk has a share in the gradient.
    grad["filters"] = np.zeros((WIDTH * DIMENSIONS, FILTERS), np.float32)
    grad["bytes"] = np.zeros((PAD + 1, DIMENSIONS), np.float32)
    for start in range(0, len(chunks), BLOCK):
        block = slice(start, start + BLOCK)
        offsets = where[block][:, :, None] * STRIDE + np.arange(WIDTH)
        numbers = chunks[block][np.arange(len(offsets))[:, None, None], offsets]
        seen = net["bytes"][numbers].reshape(len(offsets), FILTERS, -1)
        grad["filters"] += np.einsum("cf,cfd->df", d_best[block], seen, optimize=True)
        d_seen = d_best[block][:, :, None] * net["filters"].T[None]
        flat, d_flat = numbers.reshape(-1), d_seen.reshape(-1, DIMENSIONS)
        grad["bytes"] += np.stack([np.bincount(flat, d_flat[:, axis], PAD + 1) for axis in range(DIMENSIONS)], axis=1).astype(np.float32)
    return grad


def fit(examples, steps=STEPS, seed=7):
    """Parameters learned from ``(text, label)`` pairs, texts as bytes; the rarer label weighs up to ``RARE`` times as much."""
    net = new_network(seed)
    if not examples:
        return net
    first = {name: np.zeros_like(value) for name, value in net.items()}
    second = {name: np.zeros_like(value) for name, value in net.items()}
    labels = np.array([label for _, label in examples], dtype=np.float32)
    share = min(max(labels.mean(), 0.02), 0.98)
    rare = min(max(share / (1 - share), 1 / RARE), RARE)
    weights = np.where(labels == 1, 1.0, rare).astype(np.float32)
    draw, waiting = np.random.default_rng(seed), np.empty(0, dtype=int)
    for step in range(1, steps + 1):
        if len(waiting) < BATCH:
            waiting = np.concatenate([waiting, draw.permutation(len(examples))])
        picked, waiting = waiting[:BATCH], waiting[BATCH:]
        parts = [chunks_of(examples[i][0]) for i in picked]
        starts, filled = np.cumsum([0, *map(len, parts[:-1])]), np.array([_filled(part) for part in parts])
        grad = _gradients(net, np.concatenate(parts), starts, filled, labels[picked], weights[picked])
        rate = RATE * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for name, value in grad.items():
            first[name] += 0.1 * (value - first[name])
            second[name] += 0.001 * (value * value - second[name])
            net[name] -= rate * first[name] / (np.sqrt(second[name]) + 1e-8)
    return net


def train(docs, labels, label="quality", id="doc_id", text="text", rows=SAMPLE_ROWS, divisor=DIVISOR, held_out=HELD_OUT):
    """Fits the network on a bounded sample of whole documents."""
    sample = labelled_sample(docs, labels, label, rows, divisor, held_out, id, text)
    found = within_bytes(sample.select("k", "y", F.encode("text", "UTF-8").alias("x")), SAMPLE_BYTES)
    return fit([(content, label) for _, label, content in found])


def score(docs, net, text="text", into="quality"):
    """The rows of ``docs`` with the probability that they are good."""
    spark = docs.sparkSession
    in_batches(spark, BATCH_ROWS)
    sent = spark.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        return pd.Series(probabilities(sent.value, list(texts)), dtype="float64")

    return docs.select(*[F.col(f"`{name}`") for name in docs.columns], probability(F.col(text)).alias(into))


@query("op3_quality_classifier")
def op3_quality_classifier(spark, sf_dir):
    """All documents with their quality score."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    net = train(docs, read(spark, sf_dir, "labels"))
    scored = score(docs, net)
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), DIVISOR) == HELD_OUT).alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= THRESHOLD).cast("int").alias("predicted"))
