"""Merkle manifest: against a plain tree, and on awkward rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from microtally.llm import merkle
from tests.llm.cases import AWKWARD, SF_DIR, as_rows, awkward, clashing, same_as_sql, table, tables


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if each is None else f"{len(str(each).encode())}:{each}" for each in fields))


def plain_tree(nodes):
    """Root, and for each node the list of (nodes before, nodes after) on its way up."""
    ways, at = [[] for _ in nodes], [[place] for place in range(len(nodes))]
    while len(nodes) > 1:
        above, members = [], []
        for start in range(0, len(nodes), 3):
            run = nodes[start:start + 3]
            for place in range(len(run)):
                for each in at[start + place]:
                    ways[each].append(("".join(run[:place]), "".join(run[place + 1:])))
            above.append(sha("".join(run)))
            members.append([each for group in at[start:start + 3] for each in group])
        nodes, at = above, members
    return nodes[0], ways


def plain_manifest(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    sources = sorted(trees, key=lambda each: b"" if each is None else b"=" + each.encode())
    built = {}
    for source in sources:
        trees[source].sort(key=lambda each: each[:3])
        built[source] = plain_tree([each[2] for each in trees[source]])
    root, over = plain_tree([built[source][0] for source in sources])
    out = []
    for source, above in zip(sources, over):
        subroot, ways = built[source]
        for (_, _, own, row), way in zip(trees[source], ways):
            steps = way + above
            shown = own
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"] is not None:
                shown = leaf(row, row["text"].replace("\n", ""))
            for before, after in steps:
                shown = sha(before + shown + after)
            proof = sha("".join(before + after for before, after in steps))
            out.append((row["doc_id"], own, subroot, root, proof, shown, shown == root))
    return sorted(map(repr, out))


def shown(docs):
    return merkle.manifest(docs, F.replace(F.col("text"), F.lit("\n"), F.lit("")),
                           F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 27, 80, 81, 82, 243, 244, 700])
def test_trees_of_all_sizes(spark, count):
    rows = [(number, f"text\n{number}", "en", ["hot", None, "é", "z"][0 if number % 3 else number % 4], number) for number in range(count)]
    docs = awkward(spark, rows, 5)
    plain = [dict(zip(docs.columns, row)) for row in rows]
    assert as_rows(shown(docs)) == plain_manifest(plain)


def test_many_sources_and_tasks(spark):
    rows = [(number, "a\nb", None, f"s{number % 300:03d}", 3) for number in range(1200)]
    docs = awkward(spark, rows, 7)
    assert as_rows(shown(docs)) == plain_manifest([dict(zip(docs.columns, row)) for row in rows])


def test_awkward_rows_and_the_sql(spark):
    rows = AWKWARD + [(11, "only one line feed\n", "en", "b", None), (None, None, None, None, None)]
    docs = awkward(spark, rows)
    found = shown(clashing(docs))
    assert as_rows(found) == plain_manifest([dict(zip(docs.columns, row)) for row in rows])
    same_as_sql(found, tables({"documents": docs}), merkle.OP12_SQL)


def test_only_changed_rows_fail(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {row.doc_id: row for row in merkle.op12_merkle_manifest(spark, SF_DIR).collect()}
    texts = {row["doc_id"]: row["text"] for row in table("documents")}
    changed = {id for id, text in texts.items() if zlib.crc32(str(id).encode()) % 2 == 0 and "\n" in (text or "")}
    assert changed and {id for id, row in found.items() if not row.verified} == changed
    assert all(row.verified for row in merkle.manifest(docs).collect())


def test_empty_table(spark):
    assert shown(awkward(spark, []).limit(0)).collect() == []
