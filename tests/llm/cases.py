"""Awkward rows that every operator must take, and small brute-force helpers."""

import glob
import os

import duckdb
import pyarrow.parquet as pq

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

PROSE = ("It was a quiet morning near the river and nobody on the long bridge had yet seen the boats that came slowly "
         "out of the mist, one behind the other, each with a single lamp at its bow.")

# (doc_id, text, lang, source, n_chars)
AWKWARD = [
    (1, PROSE, "en", "a", len(PROSE)),
    (2, PROSE, "en", "a", len(PROSE)),
    (2, PROSE, "en", "a", len(PROSE)),
    (3, "", "en", None, 0),
    (4, None, None, "b", None),
    (None, "no id at all, and yet a text of more than ten words to be read", None, None, None),
    (None, None, None, None, None),
    (5, " \n\t \r\n ", "en", "b", 6),
    (6, "word " * 30_000, "en", "c", 150_000),
    (7, "日本語のテキスト 🙂 é́  x y  z", "ja", "c", 30),
    (-8, "one two", "en", "d", 7),
    (9, "<b>&amp;</b> $$$ ### | " * 40, "en", "d", 920),
    (10, "loser " + PROSE, "en", "a", 6 + len(PROSE)),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark, rows=AWKWARD, partitions=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def clashing(docs):
    """Extra columns named like what the operators add or use."""
    from pyspark.sql import functions as F

    names = ["size", "key", "slice", "start", "score", "quality", "kept", "words", "tokens", "ids", "fp", "component", "k", "y", "html$x"]
    return docs.select("*", *[F.lit(number).alias(name) for number, name in enumerate(names)])


def table(name):
    path = f"{SF_DIR}/{name}.parquet"
    files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else path
    return pq.read_table(files).to_pylist()


def tables(frames):
    """A DuckDB connection in which small Spark frames are tables."""
    connection = duckdb.connect()
    for name, frame in frames.items():
        arrow = frame.toArrow()
        connection.register(f"{name}_arrow", arrow)
        connection.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_arrow")
    return connection


def as_rows(frame, columns=None):
    """Rows as sorted text, for comparison as a bag."""
    frame = frame.select(*columns) if columns else frame
    return sorted(repr(tuple(row)) for row in frame.collect())


def same_as_sql(frame, connection, sql):
    """Whether a frame has the rows of a query, columns matched by name."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    wanted = sorted(repr(tuple(float(v) if isinstance(v, float) else v for v in row)) for row in cursor.fetchall())
    assert sorted(names) == sorted(frame.columns)
    assert as_rows(frame, names) == wanted


def components(nodes, pairs):
    """Smallest node each node can reach."""
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {node: root(node) for node in nodes}
