"""Nearest neighbours by inner product: inverted lists, scanned column block by column block with early abandonment.

Index. Equal vectors are one node with its smallest ids, which is all that a top list can show. Lists are
the cells of centroids, fitted by k-means on about ``SAMPLE`` nodes picked by a hash; every node is put in the list
of its closest centroid, beside its randomly rotated copy. Lists are packed into shelves of at most ``SHELF_ROWS``
nodes; a larger list is spread over shelves of its own. How many lists a query probes is measured: the
exact neighbours of ``AUDITED`` queries are found by brute force over all nodes, and as many lists are probed as hold
``RECALL`` of them.

Search. Shelves and blocks of queries meet as bounded groups. Within each probed list the squared distance
|q - x|^2 = |q|^2 + |x|^2 - 2 qx is summed over blocks of rotated columns. After m of d columns it is tested
whether the candidate can still reach the query's threshold r^2 = |q|^2 + |x|^2 - 2t, t being the worst score it
would have to beat: a partial distance above r^2 (m/d) (1 + ``DOUBT``/sqrt(m))^2 rejects that, and the candidate is
abandoned. Survivors are scored on the original vectors in double precision. Each query first searches its closest
list, which gives the threshold it takes to all others. Queries with equal vectors search once.

A query goes once to each shelf on which it probes a list (with the numbers of those lists), and a shelf is
copied once for every ``BLOCK_ROWS`` queries that reach it, so a group moves about 25 MB (64 columns) for some ten
seconds of arithmetic.

Defined results
    Null, empty and zero vectors, and vectors with null or non-finite components take no part. Vectors of different
    length are no candidates for each other. Repeated rows: each is a query and each a candidate, a row is
    left out only for itself. Null id: never a query if the condition is null; as a candidate after all
    ids it ties with. Fewer candidates than asked for: all of them, as far as the probed lists hold them (all lists
    are probed where the audit asks for it). Empty table: no rows. Columns other than id and vector are ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from microtally.llm.registry import query, read, send_package
from microtally.session import checkpointed

NEIGHBOURS, RECALL, DOUBT = 20, 0.97, 2.1

# Nodes that centroids are fitted on, the most lists, rounds of k-means, and queries that are audited.
SAMPLE, MOST_LISTS, ROUNDS, AUDITED = 32_768, 4_096, 6, 96

# Nodes of a shelf, shelves at least (for tasks to share them), queries of a block, rotated columns of a block.
SHELF_ROWS, LEAST_SHELVES, BLOCK_ROWS, COLUMNS = 32_768, 24, 8_192, 16

# Scores of one step of a scan that are held at once, and the share of survivors up to which they are handled one by one.
AT_ONCE, SPARSE = 1 << 21, 0.2

FOUND = "query long, node long, score double, ids array<long>, no_ids int"


def _matrix(column, kind):
    return np.frombuffer(b"".join(column), dtype=kind).reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def usable(batches):
    """Rows whose vector takes part, as bytes of its own number type; both zeros are one."""
    for batch in batches:
        vectors, ids = batch.column("vector"), batch.column("id")
        kind = np.float32 if vectors.type.value_type == pa.float32() else np.float64
        kept, cells = [], []
        for at, vector in enumerate(vectors):
            numbers = vector.values.cast(pa.float64()).to_numpy(zero_copy_only=False) if vector.is_valid else np.zeros(0)
            if np.isfinite(numbers).all() and numbers.any():
                kept.append(at)
                cells.append((numbers.astype(kind) + kind(0)).tobytes())
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(kept, pa.int64())), pa.array(cells, pa.binary())], ["id", "cells"])


def fit_centroids(sample, lists):
    """Centroids of ``lists`` cells of a sample, by k-means from rows spread over it."""
    centres = sample[np.linspace(0, len(sample) - 1, lists).astype(int)].copy()
    for _ in range(ROUNDS):
        nearest = closest(sample, centres)
        order = np.argsort(nearest, kind="stable")
        firsts = np.flatnonzero(np.r_[True, np.diff(nearest[order]) > 0])
        filled = nearest[order][firsts]
        centres[filled] = np.add.reduceat(sample[order], firsts, axis=0) / np.diff(np.r_[firsts, len(order)])[:, None]
    return centres


def closest(vectors, centres):
    """Number of the closest centroid of each vector."""
    half, step = 0.5 * (centres * centres).sum(1), max(1, AT_ONCE // len(centres))
    return np.concatenate([np.nan_to_num(vectors[at:at + step] @ centres.T - half, nan=-np.inf).argmax(1) for at in range(0, len(vectors), step)]
                          or [np.zeros(0, np.int64)])


def probe_order(queries, centres):
    """Lists in the order in which queries probe them."""
    return np.argsort(-np.nan_to_num(queries @ centres.T), axis=1, kind="stable")


def pack_shelves(sizes, order, rows):
    """First shelf and number of shelves of each list: small lists share one in the given order, large ones have several."""
    first, parts, shelf, used = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, 0
    for each in order:
        if sizes[each] > rows:
            parts[each] = -(-sizes[each] // rows)
            shelf += used > 0
            first[each] = shelf
            shelf, used = shelf + parts[each], 0
        else:
            if used + sizes[each] > rows:
                shelf, used = shelf + 1, 0
            first[each], used = shelf, used + sizes[each]
    return first, parts


class Best:
    """The best nodes of each query so far, ties by smallest id."""

    def __init__(self, queries, keep, floor):
        self.keep, self.floor = keep, floor
        self.scores = np.full((queries, keep), -np.inf)
        self.nodes = np.full((queries, keep), -1)

    def threshold(self, asks):
        """The worst score that still counts."""
        return np.maximum(self.floor[asks], self.scores[asks, -1])

    def add(self, asks, nodes, scores, first_ids):
        """Takes scored pairs in."""
        touched = np.unique(asks)
        a = np.concatenate([np.repeat(touched, self.keep), asks])
        n = np.concatenate([self.nodes[touched].ravel(), nodes])
        s = np.concatenate([self.scores[touched].ravel(), scores])
        order = np.lexsort((np.where(n < 0, np.iinfo(np.int64).max, first_ids[n]), -s, a))
        a, n, s = a[order], n[order], s[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        top = place < self.keep
        self.nodes[a[top], place[top]], self.scores[a[top], place[top]] = n[top], s[top]


class Turned:
    """Rotated vectors with the squares of their first columns, block by block."""

    def __init__(self, turned):
        self.cells = turned
        width = turned.shape[1]
        self.ends = [*range(COLUMNS, width, COLUMNS), width]
        squares = np.cumsum(turned.astype(np.float64) ** 2, axis=1)
        self.squares = squares[:, [end - 1 for end in self.ends]]


def survivors(queries, asks, nodes, members, threshold, doubt=DOUBT):
    """Pairs of a list that no test abandons, by place in ``asks`` and ``members``, with their rotated product.

    Products are summed over column blocks for all pairs while most of them survive, and for the survivors alone
    after that. A comparison with what is not a number never abandons.
    """
    whole_q, whole_x = queries.squares[asks, -1], nodes.squares[members, -1]
    width, start = queries.ends[-1], 0
    radius = whole_q[:, None] + whole_x[None, :] - 2 * threshold[:, None]
    dense, a, b = np.zeros((len(asks), len(members)), np.float32), None, None
    alive, products = np.ones(dense.shape, bool), None
    for block, end in enumerate(queries.ends):
        allowed = (end / width) * (1 + doubt / np.sqrt(end)) ** 2 if end < width else 1 + 1e-4
        if a is None:
            dense += queries.cells[asks, start:end] @ nodes.cells[members, start:end].T
            partial = queries.squares[asks, block][:, None] + nodes.squares[members, block][None, :] - 2 * dense
            alive &= ~(partial > allowed * radius + 1e-5 * (whole_q[:, None] + whole_x[None, :]))
            if alive.sum() <= SPARSE * alive.size or end == width:
                a, b = np.nonzero(alive)
                products = dense[a, b]
        else:
            products = products + np.einsum("ij,ij->i", queries.cells[asks[a], start:end], nodes.cells[members[b], start:end])
            partial = queries.squares[asks[a], block] + nodes.squares[members[b], block] - 2 * products
            fine = ~(partial > allowed * radius[a, b] + 1e-5 * (whole_q[a] + whole_x[b]))
            a, b, products = a[fine], b[fine], products[fine]
        start = end
    return a, b


def scan(nodes, asks, keep, kind, doubt=DOUBT):
    """The best nodes of a shelf for each query of a block: positions of queries and nodes, and scores.

    ``nodes`` has ``list, ids, cells, turned``, ``asks`` has ``cells, turned, floor, lists``.
    """
    own, others = _matrix(asks["cells"], kind).astype(np.float64), _matrix(nodes["cells"], kind).astype(np.float64)
    queries, candidates = Turned(_matrix(asks["turned"], np.float32)), Turned(_matrix(nodes["turned"], np.float32))
    first_ids = np.array([ids[0] if len(ids) else np.iinfo(np.int64).max for ids in nodes["ids"]], dtype=np.int64)
    best = Best(len(asks), keep, asks["floor"].to_numpy(np.float64))
    probing = np.repeat(np.arange(len(asks)), [len(lists) for lists in asks["lists"]])
    probed = np.concatenate([np.asarray(lists, np.int64) for lists in asks["lists"]])
    list_of = nodes["list"].to_numpy()
    for each in np.unique(list_of):
        members, users = np.flatnonzero(list_of == each), probing[probed == each]
        step = max(1, min(len(members), 1_024, AT_ONCE // max(1, len(users))))
        rows = max(1, AT_ONCE // step)
        for at in range(0, len(members), step):
            some = members[at:at + step]
            for of in range(0, len(users), rows):
                who = users[of:of + rows]
                threshold = best.threshold(who)
                a, b = survivors(queries, who, candidates, some, threshold, doubt)
                scores = _exact(own, who[a], others, some[b])
                fine = ~(scores < threshold[a])
                best.add(who[a[fine]], some[b[fine]], scores[fine], first_ids)
    query, place = np.nonzero(best.nodes >= 0)
    return query, best.nodes[query, place], best.scores[query, place]


def _exact(own, a, others, b):
    """Inner products of pairs in double precision, some at a time."""
    step = max(1, AT_ONCE // max(1, own.shape[1]))
    return np.concatenate([np.einsum("ij,ij->i", own[a[at:at + step]], others[b[at:at + step]]) for at in range(0, len(a), step)] or [np.zeros(0)])


def _scanner(keep, kind, doubt):
    def meet(nodes: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes) or not len(asks):
            return pd.DataFrame({"query": [], "node": [], "score": [], "ids": np.zeros(0, object), "no_ids": []})
        query, node, score = scan(nodes, asks, keep, kind, doubt)
        return pd.DataFrame({"query": asks["node"].to_numpy()[query], "node": nodes["node"].to_numpy()[node], "score": score,
                             "ids": list(nodes["ids"].to_numpy()[node]), "no_ids": nodes["no_ids"].to_numpy()[node]})

    return meet


def top_rows(found, keep, by="query"):
    """The best ``keep`` rows of each query, cut in every task before they meet."""
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.asc_nulls_last(F.get("ids", F.lit(0))), "node")
    return found.withColumn("place$", F.row_number().over(order)).filter(F.col("place$") <= keep).drop("place$")


class Index:
    """Shelves of one length of vectors, and the queries' way to them."""

    def __init__(self, nodes, queries, kind, keep, recall=RECALL, doubt=DOUBT):
        self.spark, self.kind, self.keep, self.doubt = nodes.sparkSession, kind, keep, doubt
        size, broadcast = nodes.count(), self.spark.sparkContext.broadcast
        part = (F.xxhash64("cells").bitwiseAND(F.lit((1 << 30) - 1)) / (1 << 30)) < SAMPLE / max(size, 1)
        sample = _matrix([bytes(row.cells) for row in nodes.filter(part).orderBy("cells").select("cells").collect()], kind).astype(np.float64)
        if not len(sample):
            sample = _matrix([bytes(row.cells) for row in nodes.limit(1).select("cells").collect()], kind).astype(np.float64)
        self.lists = int(max(1, min(MOST_LISTS, round(size**0.5), len(sample))))
        self.centres = broadcast(fit_centroids(sample[np.random.default_rng(3).permutation(len(sample))], self.lists))
        width = sample.shape[1]
        self.turn = broadcast(np.linalg.qr(np.random.default_rng(5).standard_normal((width, width)))[0])
        self.index = checkpointed(nodes.mapInArrow(self._assign(), "list int, node long, ids array<long>, no_ids int, cells binary, turned binary"))
        counted = dict(tuple(row) for row in self.index.groupBy("list").count().collect())
        sizes = np.array([counted.get(each, 0) for each in range(self.lists)])
        rows = min(SHELF_ROWS, max(1, -(-size // LEAST_SHELVES)))
        near = closest(self.centres.value, fit_centroids(self.centres.value, max(1, min(self.lists, int(size // rows)))))
        self.first, self.parts = pack_shelves(sizes, np.argsort(near, kind="stable"), rows)
        self.probes = self._audited(queries, recall)

    def _assign(self):
        centres, turn, kind = self.centres, self.turn, self.kind

        def assign(batches):
            for batch in batches:
                if batch.num_rows:
                    vectors = _matrix(batch.column("cells").to_pylist(), kind).astype(np.float64)
                    turned = (vectors @ turn.value).astype(np.float32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(closest(vectors, centres.value), pa.int32()), *[batch.column(name) for name in ("node", "ids", "no_ids", "cells")],
                         pa.array([row.tobytes() for row in turned], pa.binary())], ["list", "node", "ids", "no_ids", "cells", "turned"])

        return assign

    def _audited(self, queries, recall):
        """Lists to probe for ``recall`` of the exact neighbours of some queries, found by brute force over all nodes."""
        asked = queries.orderBy(F.xxhash64("cells"), "cells").limit(AUDITED).select("node", "cells").collect()
        if not asked:
            return 1
        vectors, names = _matrix([bytes(row.cells) for row in asked], self.kind).astype(np.float64), [row.node for row in asked]
        true = brute_force(self.index, vectors, names, self.kind, self.keep).filter("query != node").collect()
        at = {name: place for place, name in enumerate(names)}
        places = np.argsort(probe_order(vectors, self.centres.value), axis=1)
        needed = np.sort([places[at[row.query], row.list] for row in true])
        return int(needed[int(np.ceil(recall * len(needed))) - 1]) + 1 if len(needed) else 1

    def asking(self, queries, nearest_only):
        """A row for each query and shelf: the lists it probes there, the closest one or all the others."""
        centres, first, parts, probes, kind = self.centres, self.first, self.parts, self.probes, self.kind

        def ask(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = _matrix(batch.column("cells").to_pylist(), kind).astype(np.float64)
                order = probe_order(vectors, centres.value)
                order = order[:, :1] if nearest_only else order[:, 1:probes]
                rows, lists = np.repeat(np.arange(len(vectors)), order.shape[1]), order.ravel()
                copies = parts[lists]
                rows, lists, number = np.repeat(rows, copies), np.repeat(lists, copies), np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                shelves = first[lists] + number
                by = np.lexsort((lists, shelves, rows))
                rows, shelves, lists = rows[by], shelves[by], lists[by]
                starts = np.flatnonzero(np.r_[True, (np.diff(rows) != 0) | (np.diff(shelves) != 0)][:len(rows)])
                probed = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(rows)], pa.int32()), pa.array(lists, pa.int32()))
                taken = batch.take(pa.array(rows[starts]))
                yield pa.RecordBatch.from_arrays([pa.array(shelves[starts], pa.int64()), *[taken.column(name) for name in ("node", "cells", "turned", "floor")], probed],
                                                 ["shelf", "node", "cells", "turned", "floor", "lists"])

        return queries.mapInArrow(ask, "shelf long, node long, cells binary, turned binary, floor double, lists array<int>")

    def scanned(self, asking):
        """Best nodes of every query on each shelf it goes to."""
        asking = checkpointed(asking)
        blocks = asking.groupBy("shelf").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
        shelves = self.spark.createDataFrame([(each, int(self.first[each]), int(self.parts[each])) for each in range(self.lists)], "list int, first long, parts long")
        placed = self.index.join(F.broadcast(shelves), "list").withColumn("shelf", F.col("first") + F.pmod(F.xxhash64("node"), F.col("parts"))).drop("first", "parts")
        # One row per shelf: at most one for every SHELF_ROWS / 2 nodes, beside one per list.
        counts = F.broadcast(blocks)
        held = placed.join(counts, "shelf").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
        sent = asking.join(counts, "shelf").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).drop("blocks")
        return held.groupBy("shelf", "block").cogroup(sent.groupBy("shelf", "block")).applyInPandas(_scanner(self.keep, self.kind, self.doubt), FOUND)

    def search(self, queries):
        """The best ``keep`` nodes of each query: ``query, node, score, ids``."""
        turned = queries.join(self.index.select("node", "turned"), "node").select("node", "cells", "turned", F.lit(float("-inf")).alias("floor"))
        turned = checkpointed(turned)
        home = checkpointed(top_rows(self.scanned(self.asking(turned, True)), self.keep))
        if self.probes == 1:
            return home
        reached = home.groupBy("query").agg(F.when(F.count("*") >= self.keep, F.min("score")).alias("floor"))
        sharper = turned.drop("floor").join(reached.withColumnRenamed("query", "node"), "node", "left").fillna({"floor": float("-inf")})
        rest = self.scanned(self.asking(sharper, False))
        return top_rows(home.unionByName(rest), self.keep)


def brute_force(index, vectors, names, kind, keep):
    """Exact best nodes of a few queries, with their lists; every task sends its best ones only."""
    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = vectors @ _matrix(batch.column("cells").to_pylist(), kind).astype(np.float64).T
            some = min(keep, scores.shape[1])
            top = np.argpartition(-scores, some - 1, axis=1)[:, :some]
            rows = top.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(names, some), pa.int64()), batch.column("node").take(pa.array(rows)), pa.array(np.take_along_axis(scores, top, 1).ravel()),
                 *[batch.column(name).take(pa.array(rows)) for name in ("ids", "no_ids", "list")]], ["query", "node", "score", "ids", "no_ids", "list"])

    return top_rows(index.select("node", "cells", "ids", "no_ids", "list").mapInArrow(compare, FOUND + ", list int"), keep)


def nearest(vectors, asks, id="vec_id", vector="embedding", neighbours=NEIGHBOURS, recall=RECALL, doubt=DOUBT):
    """``query_id, rank, vec_id, score``: the nearest other rows of each row for which ``asks``, a Column over ``id``, holds."""
    spark = vectors.sparkSession
    send_package(spark)
    keep = neighbours + 1  # the query's own row is among them
    kind = np.float32 if vectors.schema[vector].dataType.elementType.simpleString() == "float" else np.float64
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks"))
    cells = checkpointed(rows.select("id", "vector", "asks").mapInArrow(_with_asks, "id long, cells binary, asks boolean"))
    smallest = Window.partitionBy("cells").orderBy(F.asc_nulls_last("id"))
    few = cells.select("id", "cells").withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= keep)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("place", "id"))), lambda each: each.id)
    named = few.groupBy("cells").agg(ids.alias("all")).select("cells", F.array_compact("all").alias("ids"), F.size(F.filter("all", F.isnull)).alias("no_ids"))
    nodes = checkpointed(named).withColumn("node", F.monotonically_increasing_id())
    queries = checkpointed(cells.filter("asks").select("id", "cells").join(nodes.select("cells", "node"), "cells"))
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for (size,) in queries.select(F.octet_length("cells").alias("bytes")).distinct().orderBy("bytes").collect():
        of_size = F.octet_length("cells") == size
        own = queries.filter(of_size)
        index = Index(nodes.filter(of_size), own.select("node", "cells").distinct(), kind, keep, recall, doubt)
        found = index.search(own.select("node", "cells").distinct())
        out = out.unionByName(_ranked(own.select(F.col("id").alias("query_id"), F.col("node").alias("query")), found, neighbours))
    return out


def _with_asks(batches):
    for batch in batches:
        places = pa.array(range(batch.num_rows), pa.int64())
        for kept in usable([pa.RecordBatch.from_arrays([places, batch.column("vector")], ["id", "vector"])]):
            rows = kept.column("id")
            yield pa.RecordBatch.from_arrays([batch.column("id").take(rows), kept.column("cells"), batch.column("asks").take(rows)], ["id", "cells", "asks"])


def _ranked(queries, found, neighbours):
    """Rows of the best nodes in their order, without the query's own row."""
    rows = F.transform(F.concat("ids", F.array_repeat(F.lit(None).cast("long"), F.col("no_ids"))), lambda each: F.struct((-F.col("score")).alias("less"), each.isNull().alias("no_id"), each.alias("vec_id"),
                                                    (F.col("node") == F.col("query")).alias("same"), F.col("score").alias("score")))
    lists = found.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list(rows))), 1, neighbours + 1).alias("best"))
    joined = queries.join(lists, "query")
    itself = F.array_position(F.transform("best", lambda each: each.same & each.vec_id.eqNullSafe(F.col("query_id"))), True)
    others = joined.withColumn("itself", itself).select("query_id", F.slice(F.filter("best", lambda each, at: at + 1 != F.col("itself")), 1, neighbours).alias("best"))
    return others.select("query_id", F.posexplode("best").alias("at", "each")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "each.vec_id", "each.score")


@query("op13_nearest_neighbours")
def op13_nearest_neighbours(spark, sf_dir):
    """The 20 nearest other vectors of every vector whose id is divisible by 20."""
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
