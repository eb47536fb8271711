"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit for each of 64 positions: set if the position is set in more than
half of the hashes of its three-word shingles. Texts are linked if their fingerprints differ in at
most ``distance`` bits, and groups are the connected components of the links.

Fingerprints are compared once per value, so copies cost nothing. For the search a fingerprint is
cut into two segments. If two fingerprints differ in at most ``distance`` bits, then either the
high segment differs in at most ``distance // 2`` bits, or the low one differs in fewer than
``distance - distance // 2`` bits. Each fingerprint therefore asks one table for every value in the
ball of the first radius around its high segment, another for the ball around its low segment,
and what it fetches is compared in full. To keep the lists that are fetched short where many
fingerprints share a segment, the other segment takes part in the key: with ``d`` bits spent on one
segment at most ``distance - d`` are left for the other, so one of its ``distance - d + 1`` parts
must agree exactly.

Defined results
    null and empty texts, and texts without words: fingerprint zero, linked like any other. Fewer
    than three words: one shingle of all words. Repeated rows: one row each, in the same group.
    Null id: never names a group that has another id; a group without any id has a null component.
    Empty table: no rows. Columns other than id and text are ignored.
"""

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Window, functions as F

from microtally.llm.components import connected_components
from microtally.llm.registry import in_batches, query, read
from microtally.session import checkpointed

# Words in a shingle, seed of the hash, bits that linked fingerprints may differ in.
SHINGLE = 3
SEED = 42
DISTANCE = 2

SEGMENT_BITS = 32
BATCH_ROWS = 256


def text_fingerprint(text, shingle=SHINGLE):
    """Fingerprint of a text as a signed 64-bit number."""
    # On bytes, lower() changes A-Z only, and split() parts at the six characters that part words.
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[start:] for start in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view(np.int64)[0])


def fingerprint(text):
    """Fingerprint column of a text column."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(each) for each in texts], dtype="int64")

    return fingerprints(text)


def _ball(radius):
    """All masks of a segment with ``radius`` bits set."""
    return [sum(1 << bit for bit in bits) for bits in combinations(range(SEGMENT_BITS), radius)]


def _parts(count):
    """Shift and width of ``count`` parts of a segment."""
    edges = [SEGMENT_BITS * place // count for place in range(count + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _segments(fp):
    return F.shiftrightunsigned(fp, SEGMENT_BITS), fp.bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _keys(fp, distance, probing):
    """Keys of a fingerprint: where it stands in the tables, or where it looks things up.

    Each key is ``(table, segment value, part value)``. A table is named by the segment, the bits
    spent on that segment and the part of the other one.
    """
    high, low = _segments(fp)
    first = distance // 2
    tables = [(0, high, low, spent) for spent in range(first + 1)]
    tables += [(1, low, high, spent) for spent in range(distance - first)]
    def standing(segment, part, table):
        return lambda mask: F.struct(table.alias("table"), segment.bitwiseXOR(mask).alias("segment"), part.alias("part"))

    keys = []
    for name, segment, other, spent in tables:
        masks = F.array(*[F.lit(mask) for mask in (_ball(spent) if probing else [0])]).cast("array<long>")
        for place, (shift, width) in enumerate(_parts(distance - spent + 1)):
            part = F.shiftrightunsigned(other, shift).bitwiseAND(F.lit((1 << width) - 1))
            keys.append(F.transform(masks, standing(segment, part, F.lit(name * 10000 + spent * 100 + place))))
    return F.explode(F.concat(*keys))


def close_fingerprints(fingerprints, fp="fp", distance=DISTANCE):
    """All pairs ``(a, b)``, ``a < b``, of distinct fingerprints that differ in at most ``distance`` bits."""
    values = fingerprints.select(F.col(fp).alias("fp"))
    looked_up = values.select(F.col("fp").alias("a"), _keys(F.col("fp"), distance, True).alias("key")).select("a", "key.*")
    tables = values.select(F.col("fp").alias("b"), _keys(F.col("fp"), distance, False).alias("key")).select("b", "key.*")
    different = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    same = (F.col("q.table") == F.col("t.table")) & (F.col("q.segment") == F.col("t.segment")) & (F.col("q.part") == F.col("t.part"))
    pairs = looked_up.alias("q").join(tables.alias("t"), same & (F.col("a") < F.col("b")) & (different <= distance))
    return pairs.select("a", "b").distinct()


def near_duplicates(docs, id="doc_id", text="text", distance=DISTANCE, keep=()):
    """One row per row of ``docs``: ``doc_id, fp, component_id`` and the columns of ``keep``.

    ``component_id`` is the smallest id that links reach, its own included.
    """
    in_batches(docs.sparkSession, BATCH_ROWS)
    kept = [F.col(f"`{name}`") for name in keep]
    prints = checkpointed(docs.select(F.col(id).alias("doc_id"), *kept, fingerprint(F.col(text)).alias("fp")))
    values = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    grouped = connected_components(close_fingerprints(values, distance=distance))
    named = values.join(grouped.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = named.join(names, "component").select("fp", "component", "component_id")
    return prints.join(classes, "fp").select("doc_id", *kept, "fp", "component", "component_id")


def one_of_each_group(docs, id="doc_id", text="text", distance=DISTANCE):
    """The rows of ``docs`` that stay: one per group, that of the smallest id; a null id comes last.

    Rows are told apart by a hash over all their columns, so only equal rows share one, and of
    equal rows one stays.
    """
    names = [F.col(f"`{name}`") for name in docs.columns]
    keyed = docs.select(F.struct(*names).alias("s$row"), F.col(id).alias("s$id"), F.col(text).alias("s$text"))
    parts = [part for name in docs.columns for part in (F.col("s$row")[name].isNull(), F.col("s$row")[name])]
    keyed = keyed.withColumn("s$key", F.xxhash64(*parts))
    found = near_duplicates(keyed, "s$id", "s$text", distance, keep=["s$key"])
    order = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col("s$key").alias("key"))
    chosen = found.groupBy("component").agg(F.min(order)["key"].alias("s$key")).select("s$key").distinct()
    equal = Window.partitionBy("s$key").orderBy("s$key")
    stay = keyed.join(chosen, "s$key", "left_semi").withColumn("s$copy", F.row_number().over(equal)).filter("`s$copy` = 1")
    return stay.select(*[F.col("s$row")[name].alias(name) for name in docs.columns])


@query("op7_simhash_dedup")
def op7_simhash_dedup(spark, sf_dir):
    """All documents with their fingerprint and the smallest id of their group."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
