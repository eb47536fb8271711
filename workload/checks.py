"""Contract checks, the raw gate and their reports."""

from pyspark.sql import functions as F

from microtally.operators import joins, quality, raw_gate, staging
from microtally.session import checkpointed, scratch_path
from microtally.sources import files
from workload import cleaning, roles
from workload.registry import query, read
from workload.roles import with_roles

LINE_SPEC = {
    "primary_key": ["l_orderkey", "l_linenumber"],
    "min_rows": 100,
    "columns": {
        "l_orderkey": {"type": "integer", "nullable": False, "min": 0},
        "l_linenumber": {"type": "integer", "nullable": False, "min": 1, "max": 5},
        "l_quantity": {"type": "integer", "min": 2},
        "l_returnflag": {"type": "string", "nullable": False, "accepted_values": ["A", "R"]},
        "l_linestatus": {"type": "string", "accepted_values": ["F", "O"], "severity": "warning"},
        "l_discount": {"type": "float", "max": 0.05, "severity": "warning"},
        "l_comment": {"type": "string", "nullable": False},
        "l_note": {"type": "string", "required": False},
    },
    "foreign_keys": [
        {"columns": ["l_orderkey"], "references": {"table": "orders", "columns": ["o_orderkey"]}},
        {"columns": ["l_partkey"], "references": {"table": "not_loaded", "columns": ["p_partkey"]}},
    ],
}

SHARED = "CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS bigint)"


def row(check, target, failing, severity="error"):
    return f"""SELECT 'lineitem' AS "table", '{check}' AS "check", '{target}' AS target,
        CAST(({failing}) AS bigint) AS failing_rows, '{severity}' AS severity"""


def lines(condition):
    return f"SELECT count(*) FROM lineitem WHERE {condition}"


ALL_COLUMNS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, " \
              "l_returnflag, l_linestatus, l_shipdate"
VALIDATE_ROWS = [
    row("row_count", "*", "SELECT CASE WHEN count(*) < 100 THEN 1 ELSE 0 END FROM lineitem"),
    row("required_columns", "l_orderkey,l_linenumber,l_quantity,l_returnflag,l_linestatus,l_discount,l_comment", "1"),
    row("dtype", "l_orderkey", "0"), row("dtype", "l_linenumber", "0"),
    row("dtype", "l_quantity", "SELECT count(*) FROM lineitem"),
    row("dtype", "l_returnflag", "0"), row("dtype", "l_linestatus", "0", "warning"),
    row("dtype", "l_discount", "0", "warning"),
    row("not_null", "l_orderkey", lines("l_orderkey IS NULL")),
    row("not_null", "l_linenumber", lines("l_linenumber IS NULL")),
    row("not_null", "l_returnflag", lines("l_returnflag IS NULL")),
    row("range", "l_orderkey", lines("l_orderkey < 0")),
    row("range", "l_linenumber", lines("l_linenumber < 1 OR l_linenumber > 5")),
    row("range", "l_quantity", lines("l_quantity < 2")),
    row("range", "l_discount", lines("l_discount > 0.05"), "warning"),
    row("accepted_values", "l_returnflag", lines("l_returnflag NOT IN ('A', 'R')")),
    row("accepted_values", "l_linestatus", lines("l_linestatus NOT IN ('F', 'O')"), "warning"),
    row("unique", "l_orderkey,l_linenumber",
        f"SELECT {SHARED} FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"),
    row("exact_duplicates", "*", f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM lineitem GROUP BY {ALL_COLUMNS})"),
    row("foreign_key", "l_orderkey",
        "SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
]
RESULTS_SQL = "SELECT *, failing_rows = 0 AS passed FROM (" + " UNION ALL ".join(VALIDATE_ROWS) + ")"


def line_results(spark, sf_dir):
    tables = {"orders": read(spark, sf_dir, "orders")}
    return quality.validate_table(read(spark, sf_dir, "lineitem"), "lineitem", LINE_SPEC, tables)


@query("validate_table", RESULTS_SQL)
def validate_table(spark, sf_dir):
    return quality.results_frame(spark, line_results(spark, sf_dir)).drop("detail")


@query("validation_report", f"""
    SELECT 'staging' AS stage, count(*) AS checks_run,
           count(*) FILTER (WHERE NOT passed AND severity = 'error') AS checks_failed,
           count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings FROM ({RESULTS_SQL})""")
def validation_report(spark, sf_dir):
    folder = scratch_path(spark, "reports")
    results = line_results(spark, sf_dir)
    quality.write_report(spark, folder, "staging", "batch-1", results[:3])
    quality.write_report(spark, folder, "staging", "batch-2", results)
    return quality.latest_reports(spark, folder).select("stage", "checks_run", "checks_failed", "warnings")


@query("dq_row_count", """
    SELECT t AS "table", n >= 1000 AS passed, CAST(n < 1000 AS bigint) AS failing_rows,
           format('{:,} rows, at least 1,000 expected', n) AS detail
    FROM (SELECT 'lineitem' AS t, count(*) AS n FROM lineitem UNION ALL SELECT 'region', count(*) FROM region)""")
def dq_row_count(spark, sf_dir):
    results = []
    for table, key in (("lineitem", ["l_orderkey", "l_linenumber"]), ("region", ["r_regionkey"])):
        spec = {"primary_key": key, "min_rows": 1000, "columns": {}}
        results += quality.validate_table(read(spark, sf_dir, table), table, spec)
    return quality.results_frame(spark, results).where("check = 'row_count'").select("table", "passed", "failing_rows", "detail")


@query("dq_schema", """
    SELECT * FROM (VALUES ('l_orderkey', true), ('l_quantity', false), ('l_returnflag', true), ('l_discount', true))
        t(column_name, typed), (SELECT count(*) AS rows FROM lineitem)""")
def dq_schema(spark, sf_dir):
    table = read(spark, sf_dir, "lineitem")
    rules = {name: LINE_SPEC["columns"][name]["type"] for name in ("l_orderkey", "l_quantity", "l_returnflag", "l_discount")}
    checked = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.lit(quality.has_type(table, name, kind)).alias("typed"))
        for name, kind in rules.items()
    ])
    return table.agg(F.count("*").alias("rows")).select("rows", F.inline(checked))


@query("dq_not_null", with_roles("v1_literacy", sql="""
    SELECT count(*) FILTER (WHERE bliterate IS NULL) AS bliterate, count(*) FILTER (WHERE reading IS NULL) AS reading,
           count(*) FILTER (WHERE hhid IS NULL) AS hhid FROM v1_literacy"""))
def dq_not_null(spark, sf_dir):
    rules = {name: {"type": "integer", "nullable": False} for name in ("bliterate", "reading", "hhid")}
    table = roles.staged(spark, sf_dir, "v1_literacy")
    counters = quality.column_counters(table, rules)
    return table.agg(*[counter.alias(name) for (_, name), counter in counters.items()])


@query("dq_unique", f"SELECT {SHARED} AS failing_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def dq_unique(spark, sf_dir):
    return quality.rows_sharing_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_exact_duplicates", """
    SELECT CAST(sum(n - 1) AS bigint) AS failing_rows
    FROM (SELECT count(*) AS n FROM (FROM documents UNION ALL FROM documents WHERE doc_id % 7 = 0)
          GROUP BY doc_id, text, lang, source, n_chars)
    UNION ALL SELECT CAST(sum(n - 1) AS bigint) FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, n_chars)""")
def dq_exact_duplicates(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    whole = quality.extra_copies(documents.unionByName(documents.where("doc_id % 7 = 0")), ignore=[])
    return whole.unionByName(quality.extra_copies(documents, ignore=["doc_id", "source"]))


@query("accepted_values", """
    SELECT value FROM (SELECT DISTINCT CAST(p_size AS varchar) AS value FROM part WHERE p_size NOT IN (1, 2, 3, 50))
    ORDER BY value LIMIT 10""")
def accepted_values(spark, sf_dir):
    return quality.bad_value_examples(read(spark, sf_dir, "part"), "p_size", [1, 2, 3, 50])


@query("range_check", """
    SELECT count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 9000) AS outside,
           count(*) FILTER (WHERE c_acctbal < 0) AS below, count(*) FILTER (WHERE c_acctbal > 9000) AS above FROM customer""")
def range_check(spark, sf_dir):
    return read(spark, sf_dir, "customer").agg(
        F.count_if(quality.out_of_range("c_acctbal", 0, 9000)).alias("outside"),
        F.count_if(quality.out_of_range("c_acctbal", low=0)).alias("below"),
        F.count_if(quality.out_of_range("c_acctbal", high=9000)).alias("above"),
    )


@query("foreign_key", "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def foreign_key(spark, sf_dir):
    return joins.orphan_keys(read(spark, sf_dir, "documents"), ["doc_id"], read(spark, sf_dir, "labels"), ["doc_id"])


@query("row_reconciliation", f"""WITH {cleaning.DISTINCT}, kept AS (SELECT DISTINCT l_orderkey, l_linenumber FROM firsts),
    numbers AS (SELECT (SELECT count(*) FROM copied) AS raw, (SELECT count(*) FROM kept) AS staged,
                       (SELECT count(*) FROM copied WHERE l_returnflag = 'N') AS lost,
                       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM firsts WHERE l_returnflag <> 'N')) AS others)
    SELECT 'lineitem' AS "table", 'row_reconciliation' AS "check", CAST(0 AS bigint) AS failing_rows,
           format('{{:,}} raw rows, {{:,}} staged, {{:,}} removed', raw, staged, raw - staged) AS detail FROM numbers
    UNION ALL
    SELECT 'without flag N', 'row_reconciliation', lost,
           format('{{:,}} raw rows, {{:,}} staged, {{:,}} removed', raw, others, raw - lost - others)
           || CASE WHEN lost > 0 THEN format('; {{:,}} unaccounted for', lost) ELSE '' END FROM numbers""")
def row_reconciliation(spark, sf_dir):
    """A staging that accounts for all raw rows, and one that never saw the rows of a flag."""
    copied = cleaning.copied_lines(spark, sf_dir)
    raw = copied.count()
    results = []
    for name, seen in (("lineitem", copied), ("without flag N", copied.where("l_returnflag <> 'N'"))):
        stats = staging.deduplicate(seen, cleaning.LINE_KEY, cleaning.LINE_DATA, cleaning.PLACE).stats.first()
        removed = stats.exact_duplicates_removed + stats.key_duplicates_removed
        results.append(quality.check_row_reconciliation(name, raw, stats.rows_out, removed))
    return quality.results_frame(spark, results).select("table", "check", "failing_rows", "detail")


@query("key_not_blank", r"""
    SELECT source, count(*) FILTER (WHERE NOT regexp_full_match(split_part(text, ' ', 2), '[0-9]+')) AS second_word,
           count(*) FILTER (WHERE NOT regexp_full_match(text, '[0-9]+')) AS whole_text,
           count(*) FILTER (WHERE NOT regexp_full_match(CAST(doc_id AS varchar), '[0-9]+')) AS id
    FROM documents GROUP BY source""")
def key_not_blank(spark, sf_dir):
    cells = read(spark, sf_dir, "documents").select(
        "source", F.split_part("text", F.lit(" "), F.lit(2)).alias("second_word"), F.col("text").alias("whole_text"),
        F.col("doc_id").cast("string").alias("id"),
    )
    return cells.groupBy("source").agg(*[F.count_if(raw_gate.bad_key(name)).alias(name) for name in cells.columns[1:]])


GATE_RULES = {
    "min_rows": 100,
    "required_columns": ["HHID", "LNO_F2", "RESULT_CODE_F2", "READING", "RESP_RFACT_F2", "CONSENT"],
    "key_columns": ["HHID", "LNO_F2", "READING"],
    "weight": {"column": "RESP_RFACT_F2", "positive_when": {"RESULT_CODE_F2": 1}},
}


@query("raw_gate", with_roles("v1_literacy", sql="""
    WITH rules AS (
    SELECT 'schema' AS "check", 'HHID,LNO_F2,RESULT_CODE_F2,READING,RESP_RFACT_F2,CONSENT' AS target,
           CAST(1 AS bigint) AS failing_rows
    UNION ALL SELECT 'file_presence', 'literacy', 0
    UNION ALL SELECT 'checksum', 'literacy', 1
    UNION ALL SELECT 'row_count', '*', CASE WHEN count(*) < 100 THEN 1 ELSE 0 END FROM v1_literacy
    UNION ALL SELECT 'key_not_blank', 'HHID', 0
    UNION ALL SELECT 'key_not_blank', 'LNO_F2', 0
    UNION ALL SELECT 'key_not_blank', 'READING', count(*) FILTER (WHERE reading IS NULL) FROM v1_literacy
    UNION ALL SELECT 'weight', 'RESP_RFACT_F2', count(*) FILTER (WHERE CASE WHEN result_code_f2 = 1
        THEN resp_rfact_f2 <= 0 ELSE resp_rfact_f2 <> 0 END) FROM v1_literacy)
    SELECT 'changed' AS "table", * FROM rules
    UNION ALL SELECT 'unchanged', "check", target, CASE WHEN "check" = 'checksum' THEN 0 ELSE failing_rows END FROM rules
    UNION ALL SELECT 'empty', 'file_presence', 'nothing', 1
    UNION ALL SELECT 'missing', 'file_presence', 'missing', 1"""))
def raw_gate_query(spark, sf_dir):
    """A table with a part added after it was registered, one as it was registered, an empty and a missing one."""
    root, rows = scratch_path(spark, "raw"), roles.staged(spark, sf_dir, "v1_literacy")
    places = {"changed": f"{root}/a/literacy", "unchanged": f"{root}/b/literacy", "empty": f"{root}/nothing"}
    rows.where("hhid % 2 = 0").coalesce(1).write.option("header", True).csv(places["changed"])
    rows.write.option("header", True).csv(places["unchanged"])
    rows.limit(0).select(F.lit("").alias("value")).write.text(places["empty"])
    manifest = checkpointed(files.file_manifest(spark, {t: places[t] for t in ("changed", "unchanged")}, "survey"))
    rows.where("hhid % 2 <> 0").coalesce(1).write.mode("append").option("header", True).csv(places["changed"])

    def locate(table):
        return places[table] if table in places else files.find_source(spark, root, f"{table}*")

    results = raw_gate.check_raw_files(spark, locate, dict.fromkeys([*places, "missing"], GATE_RULES), manifest)
    return quality.results_frame(spark, results).select("table", "check", "target", "failing_rows")


@query("weight_rule", """
    SELECT o_orderpriority, count(*) FILTER (WHERE o_totalprice IS NULL OR CASE WHEN o_orderstatus = 'F'
               THEN o_totalprice <= 0 ELSE o_totalprice <> 0 END) AS failing_rows,
           count(*) FILTER (WHERE o_totalprice IS NULL OR o_totalprice <= 0) AS not_positive
    FROM orders GROUP BY o_orderpriority""")
def weight_rule(spark, sf_dir):
    conditional = {"column": "o_totalprice", "positive_when": {"o_orderstatus": "F"}}
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count_if(raw_gate.bad_weight(conditional)).alias("failing_rows"),
        F.count_if(raw_gate.bad_weight({"column": "o_totalprice"})).alias("not_positive"),
    )
