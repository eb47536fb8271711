"""Connected components of an edge list, by alternating large and small stars.

Every step is a join and an aggregation over edges: a node's smallest neighbour is found with
partial aggregation, and joined back to its edges, which adaptive execution splits if a node has
very many. Each round is cut off with a checkpoint in the shared folder, so a lost executor costs
one round at most. The number of rounds grows with the logarithm of the longest chain.
"""

from pyspark.sql import functions as F

from microtally.session import checkpointed


def _state(edges):
    """Count and order-free checksum of an edge list; equal states mean that nothing moved."""
    mixed = F.xxhash64("a", "b")
    found = edges.agg(F.count("*"), F.sum(mixed.cast("decimal(38,0)")), F.bit_xor(mixed)).first()
    return tuple(found)


def _large_star(edges):
    """Each node links its larger neighbours to the smallest node around it."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges):
    """Each node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges, left="a", right="b"):
    """``(node, component)`` for every node of an edge list; the component is its smallest node.

    Loops and edges with a null end are left out; repeated edges and both directions are the same
    edge. An empty edge list has no nodes.
    """
    ends = edges.select(F.col(left).alias("x"), F.col(right).alias("y")).filter("x != y")
    now = checkpointed(ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    state = _state(now)
    while True:
        now = checkpointed(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
