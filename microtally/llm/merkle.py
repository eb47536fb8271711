"""Merkle manifest of a dataset: a digest per row, a root per source, one root for all, and a proof for every row.

A leaf is the SHA-256 of a row's fields, each written as its length and value. Per source the leaves in
id order are joined three by three, level by level, until one node remains; these subroots, in the
order of their sources, are joined likewise into the root.

Of the levels only every fourth is kept (``LEVELS``), as rows of up to 81 digests: an aligned
subtree a row. Building and proving both regenerate the levels between from the digests of a subtree,
inside the task that has them: building passes on the top node, proving emits the siblings of each
node on its way up, and both forget the rest. Proofs are made from the root down: a subtree needs the
path of its own top node, which the subtree above has just emitted. So a row meets one bounded group a
time, also in a source that holds most of the rows.

Positions within a source come from one range sort of narrow rows (no texts) that splits sources over
tasks; a task is told only how many rows of its first source stand in tasks before it.

Defined results
    null fields are written ``-``, so they differ from empty ones. Null source: a source of its own, before
    the others. Null id: before all ids of its source, never tampered. Ties (equal ids of a source) are ordered
    by leaf; rows equal in all fields have equal leaves at positions of their own, each with its proof. Empty
    and very long texts are hashed whole. Empty table: no rows. A single row: leaf, subroot and root are the
    same and its proof has no sibling. Columns other than the five fields are ignored, whatever their names.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from microtally.llm.registry import query, read, send_package
from microtally.session import checkpointed

# Nodes of a run, and the fields of a leaf in their order.
RUN = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# Levels from one kept level to the next, and nodes of a subtree between them.
LEVELS = 4
SUBTREE = RUN**LEVELS

# Subtrees worked on at once in a task.
AT_ONCE = 64

STEPS = "array<struct<before: string, after: string>>"
PROOFS = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
ARROW_PROOFS = pa.schema([("doc_id", pa.int64()), *[(name, pa.string()) for name in ("leaf", "subroot", "proof_sha256", "folded_root")]])
ARROW_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(text):
    """SHA-256 of a text as lowercase hex."""
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    """How a field enters a leaf: its length in bytes and itself, or ``-`` for a null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text, fields=FIELDS):
    """The leaf of a row whose last field is ``text``."""
    return F.sha2(F.concat(*[field(F.col(name)) for name in fields[:-1]], field(text)), 256)


def levels_above(digests, alone):
    """The levels of a subtree from its kept digests up; a tree that is ``alone`` ends where one node remains."""
    levels = [digests]
    while len(levels) <= LEVELS and not (alone and len(levels[-1]) == 1):
        below = levels[-1]
        levels.append([digest("".join(below[at:at + RUN])) for at in range(0, len(below), RUN)])
    return levels


def steps_up(levels, place):
    """What stands before and after a node's way in each run up to the top of its subtree."""
    steps = []
    for level in levels[:-1]:
        start = place - place % RUN
        steps.append({"before": "".join(level[start:place]), "after": "".join(level[place + 1:start + RUN])})
        place //= RUN
    return steps


def folded(leaf, steps):
    """The root that a leaf and the siblings of its way give."""
    for step in steps:
        leaf = digest(step["before"] + leaf + step["after"])
    return leaf


def in_position(nodes, order):
    """The nodes with their ``position`` from 0 in their ``tree``, by ``order``; ``nodes`` has been materialised."""
    keys = [F.asc_nulls_first("tree"), *[F.asc_nulls_first(name) for name in order], F.asc("tie$")]
    tied = nodes.withColumn("tie$", F.monotonically_increasing_id())
    ordered = checkpointed(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie$"))
    runs = ordered.groupBy(F.spark_partition_id().alias("part"), "tree").agg(F.count("*").alias("rows"))
    earlier = F.sum("rows").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = runs.select("part", "tree", F.coalesce(earlier, F.lit(0)).alias("before"))
    starts = {part: at for part, at in before.groupBy("part").agg(F.min_by("before", "tree")).collect()}
    return ordered.mapInArrow(_numbered(starts), f"{ordered.schema.simpleString()[7:-1]}, position: bigint")


def _numbered(starts):
    """Numbers the rows of a task; ``starts`` has the rows of its first tree in the tasks before it."""

    def number(batches):
        tree, following = None, starts.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            trees, place = batch.column("tree"), np.arange(batch.num_rows)
            fresh = np.zeros(batch.num_rows, bool)
            fresh[1:] = pc.not_equal(trees.slice(1), trees.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            fresh[0] = tree is not None and trees[0].as_py() != tree
            start = np.maximum.accumulate(np.where(fresh, place, -1))
            position = np.where(start < 0, place + following, place - start)
            tree, following = trees[-1].as_py(), position[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(position)], [*batch.schema.names, "position"])

    return number


def subtrees(nodes, payload=()):
    """One row per aligned subtree, ``tree, subtree, nodes``: its digests, with other columns, in their order."""
    members = F.array_sort(F.collect_list(F.struct("position", "digest", *payload)))
    return nodes.groupBy("tree", F.floor(F.col("position") / SUBTREE).alias("subtree")).agg(members.alias("nodes"))


def _tops(batches):
    for batch in batches:
        trees, numbers, nodes = (batch.column(name).to_pylist() for name in ("tree", "subtree", "nodes"))
        tops = [levels_above([node["digest"] for node in members], not number)[-1][0] for number, members in zip(numbers, nodes)]
        yield pa.RecordBatch.from_arrays([pa.array(trees, pa.string()), pa.array(numbers, pa.int64()), pa.array(tops, pa.string())], ["tree", "position", "digest"])


def build(nodes, payload=()):
    """The kept levels of all trees, lowest first, and ``(tree, digest)`` of their roots."""
    levels = []
    while True:
        levels.append(checkpointed(subtrees(nodes, payload)))
        nodes, payload = levels[-1].select("tree", "subtree", "nodes.digest").select(
            "tree", "subtree", F.transform("digest", lambda each: F.struct(each.alias("digest"))).alias("nodes")
        ).mapInArrow(_tops, "tree string, position long, digest string"), ()
        if not levels[-1].agg(F.max("subtree")).first()[0]:
            return levels, nodes.select("tree", "digest")


def _ways(batches):
    """For each node of a subtree its way up to the root: through the subtree, then that of its top node."""
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            out = []
            for row in batch.slice(start, AT_ONCE).to_pylist():
                levels = levels_above([node["digest"] for node in row["nodes"]], not row["subtree"])
                out += [(row["tree"], row["subtree"] * SUBTREE + place, row["subroot"], steps_up(levels, place) + row["steps"])
                        for place in range(len(row["nodes"]))]
            columns = list(zip(*out)) or [()] * 4
            types = [pa.string(), pa.int64(), pa.string(), ARROW_STEPS]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["tree", "position", "subroot", "steps"])


def _proofs(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            out = []
            for row in batch.slice(start, AT_ONCE).to_pylist():
                levels = levels_above([node["digest"] for node in row["nodes"]], not row["subtree"])
                for place, node in enumerate(row["nodes"]):
                    steps = steps_up(levels, place) + row["steps"]
                    siblings = digest("".join(step["before"] + step["after"] for step in steps))
                    shown = node["digest"] if node["tampered"] is None else node["tampered"]
                    out.append({"doc_id": node["doc_id"], "leaf": node["digest"], "subroot": row["subroot"],
                                "proof_sha256": siblings, "folded_root": folded(shown, steps)})
            yield pa.RecordBatch.from_pylist(out, ARROW_PROOFS)


def _with_way(level, ways):
    """Subtrees with the way of their top node."""
    up = ways.select(F.col("tree").alias("_tree"), F.col("position").alias("_position"), "subroot", "steps")
    return level.join(up, (F.col("tree") == F.col("_tree")) & (F.col("subtree") == F.col("_position"))).drop("_tree", "_position")


def ways_down(levels, roots):
    """From ``(tree, subroot, steps)`` of the roots, the lowest level's subtrees with the way of their top nodes."""
    ways = roots.select("tree", F.lit(0).cast("long").alias("position"), "subroot", "steps")
    for level in reversed(levels[1:]):
        ways = _with_way(level, ways).mapInArrow(_ways, f"tree string, position long, subroot string, steps {STEPS}")
    return _with_way(levels[0], ways)


def manifest(docs, tampered_text=None, tampered_where=None):
    """Leaf, subroot, root and proof of every row, checked after a change of its text.

    ``tampered_text`` is the text, a Column over ``docs``, that rows under ``tampered_where`` show to the check:
    ``folded_root`` is what their leaf and the stored siblings give, and ``verified`` whether it is the root.
    Without them every row shows its own text. Columns: ``doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified``.
    """
    spark = docs.sparkSession
    send_package(spark)
    text = F.col("text")
    shown = F.lit(None).cast("string") if tampered_text is None else F.when(
        F.coalesce(tampered_where, F.lit(False)) & (tampered_text != text), leaf_digest(tampered_text))
    source = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source")))
    leaves = docs.select(FIELDS).select(source.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                                        leaf_digest(text).alias("digest"), shown.alias("tampered"))
    placed = in_position(checkpointed(leaves), ["doc_id", "digest"])
    levels, subroots = build(placed, ["doc_id", "tampered"])

    sources = checkpointed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"))
    upper, root = build(in_position(sources, ["source"]), ["source"])
    roots = root.collect()  # one row, or none if there are no rows at all
    over = ways_down(upper, spark.createDataFrame([("", roots[0].digest if roots else "", [])], f"tree string, subroot string, steps {STEPS}"))
    each = over.mapInArrow(_sources, f"tree string, subroot string, steps {STEPS}")
    proofs = ways_down(levels, each).mapInArrow(_proofs, PROOFS)
    out = proofs.withColumn("root", F.lit(roots[0].digest if roots else "").cast("string"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sources(batches):
    """The roots of the sources, each with its way through the tree of sources."""
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            out = []
            for row in batch.slice(start, AT_ONCE).to_pylist():
                levels = levels_above([node["digest"] for node in row["nodes"]], not row["subtree"])
                out += [(node["source"], node["digest"], steps_up(levels, place) + row["steps"]) for place, node in enumerate(row["nodes"])]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, [pa.string(), pa.string(), ARROW_STEPS])], ["tree", "subroot", "steps"])


# CRC-32 of the decimal id, byte by byte and bit by bit, as DuckDB has no such function.
_BITS = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
_CRC = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)), lambda c, b: {_BITS}), 4294967295)"


def _sql_field(value):
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _sql_leaf(text):
    return "sha256(" + " || ".join([*[_sql_field(name) for name in FIELDS[:-1]], _sql_field(text)]) + ")"


OP12_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
           CASE WHEN {_CRC} % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf("text")} END AS shown
    FROM documents),
placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
nodes(lvl, source, place, digest) AS (
    SELECT 0, source, place, leaf FROM placed
    UNION ALL
    SELECT lvl + 1, source, place // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM nodes) WHERE n > 1
    GROUP BY lvl, source, place // 3),
subroots AS MATERIALIZED (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS rank
    FROM (SELECT *, max(lvl) OVER (PARTITION BY source) AS top FROM nodes) WHERE lvl = top),
upper(lvl, place, digest) AS (
    SELECT 0, rank, subroot FROM subroots
    UNION ALL
    SELECT lvl + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS n FROM upper) WHERE n > 1
    GROUP BY lvl, place // 3),
tops AS (SELECT source, max(lvl) AS top FROM nodes GROUP BY source),
top AS (SELECT max(lvl) AS top FROM upper),
documented AS MATERIALIZED (
    SELECT p.*, s.subroot, s.rank, t.top, row_number() OVER () AS id
    FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN tops t ON t.source IS NOT DISTINCT FROM p.source),
ways AS (
    SELECT d.id, 0 AS tree, n.lvl, n.place AS seat, d.place // pow(3, n.lvl)::BIGINT AS own, n.digest
    FROM documented d JOIN nodes n ON n.source IS NOT DISTINCT FROM d.source AND n.lvl < d.top
        AND n.place // 3 = d.place // pow(3, n.lvl + 1)::BIGINT
    UNION ALL
    SELECT d.id, 1, u.lvl, u.place, d.rank // pow(3, u.lvl)::BIGINT, u.digest
    FROM documented d JOIN upper u ON u.lvl < (SELECT top FROM top) AND u.place // 3 = d.rank // pow(3, u.lvl + 1)::BIGINT),
steps AS (
    SELECT id, tree, lvl, coalesce(string_agg(digest, '' ORDER BY seat) FILTER (WHERE seat < own), '') AS before,
           coalesce(string_agg(digest, '' ORDER BY seat) FILTER (WHERE seat > own), '') AS after
    FROM ways GROUP BY id, tree, lvl),
proofs AS (
    SELECT id, string_agg(before || after, '' ORDER BY tree, lvl) AS siblings,
           list(before || '|' || after ORDER BY tree, lvl) AS steps
    FROM steps GROUP BY id),
proved AS (
    SELECT d.doc_id, d.leaf, d.subroot, (SELECT digest FROM upper ORDER BY lvl DESC LIMIT 1) AS root,
           sha256(coalesce(p.siblings, '')) AS proof_sha256,
           list_reduce(list_prepend(d.shown, coalesce(p.steps, []::VARCHAR[])),
                       lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root
    FROM documented d LEFT JOIN proofs p USING (id))
SELECT *, folded_root = root AS verified FROM proved
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark, sf_dir):
    """All documents with their proofs; half of them show their text without line feeds."""
    docs = read(spark, sf_dir, "documents")
    half = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    return manifest(docs, F.replace(F.col("text"), F.lit("\n"), F.lit("")), half)
