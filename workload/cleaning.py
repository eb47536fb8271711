"""Staging: clean names and cells, typing, line numbers and de-duplication."""

from pyspark.sql import functions as F

from microtally.operators import staging
from microtally.session import scratch_path
from microtally.sources import codebook, text_tables
from workload.derive import MIXED_SQL, NUMBER_SQL, mixed_text
from workload.registry import query, read

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_DATA = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"]


def copied_lines(spark, sf_dir):
    """Line items with every tenth order key held twice, numbered by their own columns."""
    lines = read(spark, sf_dir, "lineitem").select(*LINE_DATA, "l_suppkey", "l_quantity", "l_extendedprice")
    copies = F.when(F.col("l_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return lines.withColumn("copy", F.explode(copies))


PLACE = ["l_suppkey", "l_quantity", "l_extendedprice", "copy"]
COPIED = """copied AS (SELECT *, 0 AS copy FROM lineitem UNION ALL SELECT *, 1 FROM lineitem WHERE l_orderkey % 10 = 0)"""
DISTINCT = f"""{COPIED}, firsts AS (
    SELECT * EXCLUDE rn FROM (
        SELECT {', '.join(LINE_DATA)}, {', '.join(PLACE)}, row_number() OVER (PARTITION BY {', '.join(LINE_DATA)}
               ORDER BY {', '.join(PLACE)}) AS rn,
               count(*) OVER (PARTITION BY {', '.join(LINE_DATA)}) AS copies
        FROM copied) WHERE rn = 1)"""


def deduplicated(spark, sf_dir):
    return staging.deduplicate(copied_lines(spark, sf_dir), LINE_KEY, LINE_DATA, PLACE)


@query("dedup_exact", f"WITH {DISTINCT} SELECT * FROM firsts")
def dedup_exact(spark, sf_dir):
    return staging.drop_exact_copies(copied_lines(spark, sf_dir), LINE_DATA, PLACE)


@query("dedup_key", f"""WITH {DISTINCT} SELECT * EXCLUDE (copies, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(PLACE)}, l_partkey) AS rn
    FROM firsts) WHERE rn = 1""")
def dedup_key(spark, sf_dir):
    return deduplicated(spark, sf_dir).kept


@query("dedup_rejects", f"""WITH {DISTINCT} SELECT * EXCLUDE (copies, n) FROM (
    SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM firsts) WHERE n > 1""")
def dedup_rejects(spark, sf_dir):
    return deduplicated(spark, sf_dir).rejects


@query("dedup_stats", f"""WITH {DISTINCT}, keys AS (
    SELECT count(*) AS n, sum(copies) AS copies FROM firsts GROUP BY l_orderkey, l_linenumber)
    SELECT CAST(sum(copies) AS bigint) AS rows_in, CAST(sum(copies - n) AS bigint) AS exact_duplicates_removed,
           CAST(sum(n) FILTER (WHERE n > 1) AS bigint) AS rows_sharing_a_key,
           CAST(sum(n - 1) AS bigint) AS key_duplicates_removed, count(*) AS rows_out FROM keys""")
def dedup_stats(spark, sf_dir):
    return deduplicated(spark, sf_dir).stats


def text_events(spark, sf_dir):
    """Events as raw text with untidy names and cells."""
    events = read(spark, sf_dir, "events")
    key, value = F.col("event_id"), F.col("value")
    return events.select(
        F.concat(F.lit("\t"), key.cast("string"), F.lit(" ")).alias("\ufeffEvent ID"),
        mixed_text(key, value).alias(" Mixed (raw) "),
        F.concat(F.lit(" "), (key % 5).cast("string"), F.when(key % 2 == 0, ".0").otherwise("")).alias("Whole"),
        F.when(key % 4 > 0, value.cast("string")).otherwise(F.lit("  ")).alias("Amount"),
        F.concat(F.lit("  "), "event_type").alias("TYPE"),
        F.lit(" ").alias("Nothing"),
    )


@query("standardise", f"""
    SELECT CAST(event_id AS varchar) AS event_id, nullif(trim({MIXED_SQL}), '') AS mixed_raw,
           concat(event_id % 5, CASE WHEN event_id % 2 = 0 THEN '.0' ELSE '' END) AS whole,
           CASE WHEN event_id % 4 > 0 THEN CAST(value AS varchar) END AS amount, event_type AS type,
           CAST(NULL AS varchar) AS nothing
    FROM events""")
def standardise(spark, sf_dir):
    return staging.standardise(text_events(spark, sf_dir))


@query("infer_types", f"""
    SELECT event_id, nullif(trim({MIXED_SQL}), '') AS mixed_raw, event_id % 5 AS whole,
           CASE WHEN event_id % 4 > 0 THEN value END AS amount, event_type AS type, CAST(NULL AS varchar) AS nothing
    FROM events""")
def infer_types(spark, sf_dir):
    typed, _ = staging.convert_types(staging.standardise(text_events(spark, sf_dir)))
    return typed


LARGE_SQL = """SELECT o_orderkey, CAST(9223372036854775807 - o_orderkey AS varchar) AS near_limit,
    CAST(12345678901234567890 + CAST(o_orderkey AS hugeint) AS varchar) AS twenty_digits FROM orders"""


def large_ids(spark, sf_dir):
    """Orders under ids just below 2^63 and of twenty digits, as text."""
    key = F.col("o_orderkey")
    wide = (F.lit("12345678901234567890").cast("decimal(38,0)") + key).cast("decimal(38,0)")
    text = read(spark, sf_dir, "orders").select(
        "o_orderkey", (F.lit(9223372036854775807) - key).cast("string").alias("near_limit"), wide.cast("string").alias("twenty_digits"))
    cells = text.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "near_limit", "twenty_digits")
    return staging.convert_types(cells)


@query("infer_large_integers", LARGE_SQL)
def infer_large_integers(spark, sf_dir):
    typed, types = large_ids(spark, sf_dir)
    assert types == {"o_orderkey": "long", "near_limit": "long", "twenty_digits": "decimal(38,0)"}
    return typed.select("o_orderkey", *[F.col(name).cast("string").alias(name) for name in ("near_limit", "twenty_digits")])


@query("dedup_large_keys", "SELECT count(*) AS rows_out, CAST(0 AS bigint) AS key_duplicates_removed FROM orders")
def dedup_large_keys(spark, sf_dir):
    typed, _ = large_ids(spark, sf_dir)
    key = ["near_limit", "twenty_digits"]
    found = staging.deduplicate(typed, key, key, ["o_orderkey"])
    return found.stats.select("rows_out", "key_duplicates_removed")


@query("type_counts", f"""
    SELECT count(*) FILTER (WHERE regexp_full_match(t, '[+-]?[0-9]{{1,18}}')) AS plain,
           count(*) FILTER (WHERE {NUMBER_SQL.format('t')} AND NOT regexp_full_match(t, '[+-]?[0-9]{{1,18}}')
                            AND floor(TRY_CAST(t AS double)) = TRY_CAST(t AS double)) AS whole,
           count(*) FILTER (WHERE {NUMBER_SQL.format('t')} AND floor(TRY_CAST(t AS double)) <> TRY_CAST(t AS double)) AS fraction,
           count(*) FILTER (WHERE NOT {NUMBER_SQL.format('t')}) AS text, CAST(0 AS bigint) AS big
    FROM (SELECT nullif(trim({MIXED_SQL}), '') AS t FROM events)""")
def type_counts(spark, sf_dir):
    kinds = staging.with_kinds(staging.standardise(text_events(spark, sf_dir)), ["mixed_raw"])
    return kinds.agg(*staging.type_counters(["mixed_raw"])).toDF("plain", "whole", "fraction", "text", "big")


def write_text_orders(spark, sf_dir):
    """Orders as CSV files; every row knows its place in its file."""
    path = scratch_path(spark, "orders-csv")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    orders = read(spark, sf_dir, "orders").select(
        place.alias("place"), "o_orderkey", "o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, "NA").alias("Note")
    )
    orders.write.option("header", True).csv(path)
    return path


@query("scan_text", """
    SELECT CAST(o_orderkey AS varchar) AS o_orderkey, o_orderpriority,
           CASE WHEN o_orderkey % 3 = 0 THEN 'NA' ELSE '' END AS "Note" FROM orders""")
def scan_text(spark, sf_dir):
    return text_tables.scan_text(spark, write_text_orders(spark, sf_dir)).drop("place")


@query("source_line", "SELECT count(*) AS rows, 0::bigint AS misplaced FROM orders")
def source_line(spark, sf_dir):
    numbered = text_tables.read_numbered_table(spark, write_text_orders(spark, sf_dir))
    wrong = F.col("source_line") != F.col("place").cast("long") + 2
    return numbered.agg(F.count("*").alias("rows"), F.count_if(wrong).alias("misplaced"))


# Customers as codebook sheets: one sheet per market segment and key range, a value set per
# nation, an entry per customer; a third of the entries names no upper end.
SHEET_SQL = """
    SELECT concat(c_mktsegment, c_custkey // 1000) AS source, concat('N', c_nationkey, '_VS1') AS value_set,
           concat('n', c_nationkey) AS variable, 'Nation' AS variable_label, c_custkey AS value_from,
           c_custkey + CASE WHEN c_custkey % 3 > 0 THEN 1 ELSE 0 END AS value_to, c_name AS value_label,
           CAST(c_nationkey * 10000 + c_custkey % 1000 + 1 AS bigint) AS row
    FROM customer"""


@query("codebook_filldown", SHEET_SQL)
def codebook_filldown(spark, sf_dir):
    customers = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    sheet = F.concat("c_mktsegment", F.floor(key / 1000).cast("string")).alias("source")
    start = F.col("c_nationkey").cast("long") * 10000
    nothing = F.lit(None).cast("string")
    titles = customers.select(
        sheet, start.alias("row"), F.concat(F.lit(" N"), "c_nationkey", F.lit("_VS1")).alias("c0"),
        F.lit("Nation ").alias("c1"), nothing.alias("c2"), nothing.alias("c3"), nothing.alias("c4"),
    ).distinct()
    entries = customers.select(
        sheet, (start + key % 1000 + 1).alias("row"), nothing.alias("c0"), nothing.alias("c1"),
        F.concat(F.lit(" "), "c_name").alias("c2"), F.concat(key, F.lit(".0")).alias("c3"),
        F.when(key % 3 > 0, (key + 1).cast("string")).alias("c4"),
    )
    return codebook.parse_codebook(titles.unionByName(entries))


@query("codebook_summary", f"SELECT count(*) AS value_labels, count(DISTINCT variable) AS variables FROM ({SHEET_SQL})")
def codebook_summary(spark, sf_dir):
    return codebook.codebook_summary(codebook_filldown(spark, sf_dir))
