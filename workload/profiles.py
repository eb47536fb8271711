"""Column profiles over whole tables."""

from pyspark.sql import functions as F

from microtally.operators import profiling
from workload.derive import MIXED_SQL, NUMBER_SQL, mixed_text
from workload.registry import query, read

COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props", "mixed", "sparse"]
CELLS = f"""cells AS (
    SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props', 'mixed', 'sparse']) AS "column",
           unnest([CAST(event_id AS varchar), CAST(ts AS varchar), CAST(user_id AS varchar), event_type, CAST(value AS varchar), props, {MIXED_SQL},
                   CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS varchar) ELSE ' ' END]) AS value
    FROM events),
counted AS (SELECT "column", value, count(*) AS n FROM cells GROUP BY 1, 2),
filled AS (SELECT *, CASE WHEN {NUMBER_SQL.format('trim(value)')} THEN TRY_CAST(trim(value) AS double) END AS number
           FROM counted WHERE trim(value) <> '')"""


def counts(spark, sf_dir):
    key = F.col("event_id")
    events = read(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props", mixed_text(key, F.col("value")).alias("mixed"),
        F.when(key % 3 == 0, F.col("user_id").cast("string")).otherwise(" ").alias("sparse"),
    )
    return profiling.value_counts(events, COLUMNS)


@query("profile_columns", f"""WITH {CELLS},
    totals AS (SELECT "column", sum(n) AS cells, coalesce(sum(n) FILTER (WHERE trim(value) = ''), 0) AS missing
               FROM counted GROUP BY 1),
    facts AS (SELECT "column", count(*) AS d, count(number) AS numbers, min(number) AS low, max(number) AS high,
                     sum(number * n) / sum(n) FILTER (WHERE number IS NOT NULL) AS mean FROM filled GROUP BY 1)
    SELECT "column", CASE WHEN numbers = d THEN 'numeric' ELSE 'text' END AS inferred_type,
           CAST(missing AS bigint) AS missing, round(100.0 * missing / cells, 2) AS missing_pct, d AS distinct,
           CASE WHEN numbers = d THEN low END AS min, CASE WHEN numbers = d THEN high END AS max,
           CASE WHEN numbers = d THEN round(mean, 3) END AS mean
    FROM totals JOIN facts USING ("column")""")
def profile_columns(spark, sf_dir):
    profile = profiling.profile_columns(counts(spark, sf_dir))
    return profile.withColumn("missing_pct", F.col("missing_pct").cast("double"))


@query("profile_top_values", f"""WITH {CELLS}
    SELECT "column", CAST(rank AS integer) AS rank, value, n FROM (
        SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM filled)
    WHERE rank <= 5""")
def profile_top_values(spark, sf_dir):
    return profiling.top_values(counts(spark, sf_dir))


@query("profile_flags", f"""WITH {CELLS},
    totals AS (SELECT "column", sum(n) AS cells, coalesce(sum(n) FILTER (WHERE trim(value) = ''), 0) AS missing
               FROM counted GROUP BY 1),
    facts AS (SELECT "column", count(*) AS d, count(number) AS numbers FROM filled GROUP BY 1)
    SELECT "column", round(100.0 * missing / cells, 2) >= 50 AS mostly_missing, numbers > 0 AND numbers < d AS mixed
    FROM totals JOIN facts USING ("column")""")
def profile_flags(spark, sf_dir):
    return profiling.profile_flags(counts(spark, sf_dir))


@query("profile_examples", f"""WITH {CELLS}
    SELECT "column", CAST(rank AS integer) AS rank, value FROM (
        SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) AS rank
        FROM filled WHERE number IS NULL AND "column" IN (
            SELECT "column" FROM filled GROUP BY 1 HAVING count(number) > 0 AND count(number) < count(*)))
    WHERE rank <= 5""")
def profile_examples(spark, sf_dir):
    return profiling.non_numeric_examples(counts(spark, sf_dir))


@query("profile_table", """
    SELECT CAST(sum(n) AS bigint) AS rows, 5 AS columns, CAST(sum(n - 1) AS bigint) AS exact_duplicate_rows
    FROM (SELECT count(*) AS n FROM (FROM documents UNION ALL FROM documents WHERE doc_id % 7 = 0)
          GROUP BY doc_id, text, lang, source, n_chars)""")
def profile_table(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    return profiling.profile_table(documents.unionByName(documents.where("doc_id % 7 = 0")))
