"""Near-duplicate embeddings by small-world graphs, one per shard.

Equal vectors are one vector with a count. The different ones are dealt to shards by a hash; each
shard builds a graph in one task and writes it as rows. Every block of vectors then searches
every shard: blocks and shards meet as bounded groups, never as pairs of rows. Each group audits
itself: for some of its vectors, those with links among them, the true links are counted by
brute force, and the beam is widened until enough of them are found (at the widest, all vectors
of the shard are compared). Pairs are verified by their cosine in double precision, and groups are
the connected components of the links.

Defined results
    null vectors, zero vectors, and vectors with null or non-finite components link with nothing.
    Vectors of different length are never linked. Repeated rows: one row each, linked with each
    other. Null id: takes part in links, never names a group that has another id; ``kept`` is then
    false, and a group without ids has a null component. Empty table: no rows. Columns other than id
    and vector are ignored.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from microtally.llm.components import connected_components
from microtally.llm.hnsw import Graph
from microtally.llm.registry import in_batches, query, read
from microtally.session import checkpointed

LEAST = 0.9

# Shards: this many at least, and as many more as keep them at SHARD_ROWS vectors. Blocks of
# queries have BLOCK_ROWS vectors.
SHARDS, SHARD_ROWS, BLOCK_ROWS = 8, 32_768, 8_192
# First width of the beam, and the share of true links that an audit must find.
BEAM, RECALL, AUDITED = 24, 0.995, 96


def unit_vector(vector):
    """The vector divided by its length as bytes of doubles, or None if it has no direction."""
    if vector is None or len(vector) == 0:
        return None
    numbers = np.array([np.nan if each is None else each for each in vector], dtype=np.float64)
    largest = np.abs(numbers).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    numbers = numbers / largest
    return (numbers / np.sqrt(numbers @ numbers) + 0.0).tobytes()


def _matrix(units):
    return np.frombuffer(b"".join(units), dtype=np.float64).reshape(len(units), -1)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("unit", ignore_index=True)
    graph = Graph.build(_matrix(group["unit"]), seed=len(group))
    highest, links = graph.rows()
    place = np.arange(len(group), dtype=np.int64)
    return pd.DataFrame({"shard": group["shard"], "place": place, "node": group["shard"].to_numpy() * (1 << 24) + place,
                         "unit": group["unit"], "first_id": group["first_id"], "copies": group["copies"],
                         "highest": highest.astype(np.int32), "links": links})


GRAPH = "shard long, place long, node long, unit binary, first_id long, copies long, highest int, links binary"


def linked(graph, units, queries, least=LEAST, beam=BEAM, recall=RECALL, audited=AUDITED):
    """Verified pairs ``(query, vector)`` of one shard, and the audit: width of the beam, found and true links."""
    def verified(a, b):
        fine = np.einsum("ij,ij->i", queries[a], units[b]) >= least
        return a[fine], b[fine]

    rough = least - 1e-4
    spread = np.unique(np.linspace(0, len(queries) - 1, min(audited, len(queries))).astype(int))
    while True:
        if beam >= len(units):
            found = verified(*_all_pairs(queries, units, least))
            return (*found, (len(units), len(found[0]), len(found[0])))
        a, b = verified(*graph.within(queries, rough, beam))
        with_links = np.unique(a)
        some = with_links[np.unique(np.linspace(0, len(with_links) - 1, min(audited, len(with_links))).astype(int))] if len(a) else with_links
        sample = np.union1d(spread, some)
        true = int((queries[sample] @ units.T >= least).sum())
        got = int(np.isin(a, sample).sum())
        if got >= recall * true:
            return a, b, (beam, got, true)
        beam *= 2


def _all_pairs(queries, units, least):
    """The widest beam: every vector of the shard is compared, a few hundred queries at a time."""
    rows, nodes = [], []
    for start in range(0, len(queries), 256):
        row, node = np.nonzero(queries[start:start + 256] @ units.T >= least)
        rows.append(row + start)
        nodes.append(node)
    return np.concatenate(rows), np.concatenate(nodes)


def _search(least, beam, recall):
    def search(nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes) or not len(queries):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        nodes = nodes.sort_values("place", ignore_index=True)
        units = _matrix(nodes["unit"])
        graph = Graph.from_rows(units, nodes["highest"].to_numpy(), list(nodes["links"]))
        a, b, _ = linked(graph, units, _matrix(queries["unit"]), least, beam, recall)
        a, b = queries["node"].to_numpy()[a], nodes["node"].to_numpy()[b]
        other = a != b
        low, high = np.minimum(a, b)[other], np.maximum(a, b)[other]
        return pd.DataFrame({"a": low, "b": high}).drop_duplicates()

    return search


def near_duplicate_vectors(vectors, id="vec_id", vector="embedding", least=LEAST, beam=BEAM, recall=RECALL, shards=SHARDS):
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``."""
    spark = vectors.sparkSession
    in_batches(spark, 4_096)

    @F.pandas_udf("binary")
    def unit(values: pd.Series) -> pd.Series:
        return pd.Series([unit_vector(each) for each in values], dtype=object)

    rows = checkpointed(vectors.select(F.col(id).cast("long").alias("vec_id"), unit(F.col(vector)).alias("unit")))
    classes = rows.filter("unit IS NOT NULL").groupBy("unit").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = checkpointed(classes)
    size = classes.count()
    parts, blocks = max(shards, -(-size // SHARD_ROWS)), max(1, -(-size // BLOCK_ROWS))
    length = F.octet_length("unit") / 8
    dealt = classes.withColumn("shard", (length * (1 << 16)).cast("long") + F.pmod(F.xxhash64("unit"), F.lit(parts)))
    graphs = checkpointed(dealt.groupBy("shard").applyInPandas(_build, GRAPH))

    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    nodes = graphs.select("shard", everywhere.alias("block"), "place", "node", "unit", "highest", "links")
    every_shard = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda part: (F.floor(F.col("shard") / (1 << 16)) * (1 << 16) + part).cast("long"))
    asking = graphs.select(F.explode(every_shard).alias("shard"), F.pmod(F.xxhash64("unit", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), "node", "unit")
    pairs = nodes.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block")).applyInPandas(
        _search(least, beam, recall), "a long, b long")
    pairs = checkpointed(pairs.distinct())

    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = graphs.select("node", "unit", "first_id", "copies")
    partners = both.join(counts.select(F.col("node").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    grouped = connected_components(pairs)
    named = (
        counts.join(grouped, "node", "left").join(partners.withColumnRenamed("a", "node"), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
    )
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(names, "component").select("unit", "n_links", "component_id")
    linked_rows = rows.filter("unit IS NOT NULL").join(named, "unit").select("vec_id", "n_links", "component_id")
    lone = rows.filter("unit IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked_rows.unionAll(lone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@query("op2_embedding_dedup")
def op2_embedding_dedup(spark, sf_dir):
    """All vectors with the number of their links and the smallest id of their group."""
    return near_duplicate_vectors(read(spark, sf_dir, "embeddings"))
