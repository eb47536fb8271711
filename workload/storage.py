"""Sources and sinks: each query writes whole tables and reads the result back."""

from pyspark.sql import functions as F

from microtally.errors import DuplicateShareError, SourceError
from microtally.operators import formats, load, quality, staging
from microtally.plans.survey_run import SurveyRun, write_staged
from microtally.session import checkpointed, scratch_path
from microtally.sources import datasets, files, region_list
from workload import cleaning, roles
from workload.derive import RECORDS_SQL, region_records
from workload.registry import in_order, query, read
from workload.roles import with_roles

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("roundtrip_parquet", f"SELECT {ORDERS} FROM orders")
def roundtrip_parquet(spark, sf_dir):
    path = scratch_path(spark, "orders")
    datasets.write_table(read(spark, sf_dir, "orders").limit(0), path)
    datasets.write_table(read(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@query("roundtrip_csv", """
    SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey""")
def roundtrip_csv(spark, sf_dir):
    path = scratch_path(spark, "totals")
    totals = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    datasets.write_csv_copy(totals, f"{path}/csv")
    return datasets.read_published(spark, f"{path}/parquet", f"{path}/csv", totals.schema)


@query("partition_pruned_scan", """
    SELECT c_custkey, c_name, CAST(c_nationkey AS bigint) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer WHERE c_nationkey = 7""")
def partition_pruned_scan(spark, sf_dir):
    path = scratch_path(spark, "customers")
    datasets.write_partitioned(read(spark, sf_dir, "customer"), path, "c_nationkey", ["c_custkey"])
    return datasets.read_partitioned(spark, path, 7, "c_nationkey")


@query("partitioned_write", """
    SELECT c_custkey, c_name, CAST(c_nationkey AS bigint) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer WHERE c_nationkey > 3""")
def partitioned_write(spark, sf_dir):
    path = scratch_path(spark, "customers")
    customers = read(spark, sf_dir, "customer")
    datasets.write_partitioned(customers, path, "c_nationkey")
    datasets.write_partitioned(customers.where("c_nationkey > 3"), path, "c_nationkey")
    return datasets.read_partitioned(spark, path, key="c_nationkey")


@query("pruning_report", """
    SELECT 'all' AS scope, count(*) AS rows, true AS just_its_files FROM customer
    UNION ALL SELECT 'one partition', count(*), true FROM customer WHERE c_nationkey = 7""")
def pruning_report(spark, sf_dir):
    path = scratch_path(spark, "customers")
    datasets.write_partitioned(read(spark, sf_dir, "customer"), path, "c_nationkey")
    report = formats.pruning_report(spark.read.parquet(path), 7, "c_nationkey")
    of_seven = len(files.file_statuses(spark, f"{path}/c_nationkey=7"))
    just = F.when(F.col("scope") == "all", F.col("files") >= 24 + of_seven).otherwise(F.col("files") == of_seven)
    return report.select("scope", "rows", just.alias("just_its_files"))


@query("format_fidelity", """
    SELECT f.*, (SELECT count(*) FROM customer) AS rows, 5 AS columns
    FROM (VALUES ('csv', 1, 'c_custkey'), ('json', 1, 'c_nationkey'), ('parquet', 0, '')) f(format, changed_columns, changed)""")
def format_fidelity(spark, sf_dir):
    return formats.format_fidelity(read(spark, sf_dir, "customer"), scratch_path(spark, "formats"))


# Order years as survey years: the new load halves the prices of one year.
NEW_YEAR = "SELECT o_orderkey, o_totalprice / 2 AS o_totalprice, year FROM dated WHERE year = 1998 AND o_orderkey % 2 = 0"
DATED = "WITH dated AS (SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS integer) AS year FROM orders)"


def dated_orders(spark, sf_dir):
    dated = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    new = dated.where("year = 1998 AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") / 2)
    return dated, new


@query("replace_partition", f"{DATED} SELECT * FROM dated WHERE year <> 1998 UNION ALL {NEW_YEAR}")
def replace_partition(spark, sf_dir):
    dated, new = dated_orders(spark, sf_dir)
    path = scratch_path(spark, "years")
    load.overwrite_periods(dated, path, "year")
    for _ in range(2):
        load.overwrite_periods(new, path, "year")
    return spark.read.parquet(path)


@query("replace_period", f"{DATED} SELECT * FROM dated WHERE year <> 1998 UNION ALL {NEW_YEAR}")
def replace_period(spark, sf_dir):
    dated, new = dated_orders(spark, sf_dir)
    return load.replace_period(dated, new, "year", 1998)


@query("upsert_by_key", """
    WITH old AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 3 > 0),
         new AS (SELECT c_custkey, c_name, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_custkey % 2 = 0)
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new)""")
def upsert_by_key(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = customers.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") * 2)
    return load.upsert(customers.where("c_custkey % 3 > 0"), new, ["c_custkey"])


PLAN = [
    {"table": "dim_region", "strategy": "upsert", "key": ["region_code"]},
    {"table": "household", "strategy": "replace_year"},
    {"table": "member", "strategy": "replace_year"},
]


RULES = {
    "member": {"primary_key": ["survey_year", "hhid", "line_no"], "columns": {"batch_id": {"type": "string", "nullable": False}},
               "foreign_keys": [{"columns": ["hhid"], "references": {"table": "household", "columns": ["hhid"]}}]},
}


def loaded(spark, sf_dir):
    """A warehouse after two loads of the same year, and a third that broke a rule."""
    root = scratch_path(spark, "warehouse")
    tables = {
        "dim_region": checkpointed(roles.dim_region(spark, sf_dir)),
        "household": checkpointed(roles.household(spark, sf_dir)),
        "member": checkpointed(roles.member(spark, sf_dir)),
    }
    for batch in ("load-1", "load-2"):
        load.load_tables(spark, root, tables, batch, roles.YEAR, PLAN, RULES)
    repeated = tables["member"].unionByName(tables["member"].where("line_no = 1").limit(1))
    try:
        load.load_tables(spark, root, {**tables, "member": repeated}, "load-3", roles.YEAR, PLAN, RULES)
    except quality.DataQualityError:
        return root
    raise AssertionError("a load with a repeated key was published")


@query("load_audit", with_roles("member", sql="""
    SELECT CAST(run AS bigint) AS run_id, concat('load-', run) AS batch_id, 2024 AS survey_year,
           (SELECT count(*) FROM region) AS regions, (SELECT count(*) FROM customer) AS households,
           (SELECT count(*) FROM member) AS members, true AS in_order
    FROM (SELECT unnest([1, 2]) AS run)"""))
def load_audit(spark, sf_dir):
    audit = load.read_audit(spark, loaded(spark, sf_dir))

    def counted(table):
        return F.get_json_object("row_counts", f"$.{table}").cast("long")

    return audit.select(
        "run_id", "batch_id", "survey_year", counted("dim_region").alias("regions"),
        counted("household").alias("households"), counted("member").alias("members"),
        (F.col("started_at") <= F.col("finished_at")).alias("in_order"),
    )


@query("warehouse_reload", with_roles("member", sql="""
    SELECT hhid, line_no, sex, age_group, member_weight, 'load-2' AS batch_id FROM member"""))
def warehouse_reload(spark, sf_dir):
    rows = load.read_warehouse(spark, loaded(spark, sf_dir), "member")
    return rows.select("hhid", "line_no", "sex", "age_group", "member_weight", "batch_id")


@query("load_history", with_roles("member", sql="""
    SELECT CAST(run AS bigint) AS run_id, concat('load-', run) AS batch_id, (SELECT count(*) FROM member)::varchar AS member_rows,
           CAST(3 - run AS integer) AS position FROM (SELECT unnest([1, 2]) AS run)"""))
def load_history(spark, sf_dir):
    audit = load.read_audit(spark, loaded(spark, sf_dir))
    return in_order(load.load_history(audit, 5).drop("finished_at"))


# ---------- staging sinks ----------

@query("staged_rejects", f"""WITH {cleaning.DISTINCT}, keys AS (SELECT count(*) AS n FROM firsts GROUP BY l_orderkey, l_linenumber),
    numbers AS (SELECT (SELECT count(*) FROM copied) AS raw, (SELECT count(*) FROM keys) AS kept,
                       (SELECT coalesce(sum(n), 0) FROM keys WHERE n > 1) AS shared)
    SELECT 'first' AS step, kept AS staged, CAST(shared AS bigint) AS rejects, false AS refused FROM numbers
    UNION ALL SELECT 'without repeats', kept, CAST(0 AS bigint), false FROM numbers
    UNION ALL SELECT 'too many duplicates', kept, CAST(0 AS bigint), raw > kept FROM numbers""")
def staged_rejects(spark, sf_dir):
    """What the sinks of a batch hold after a run with rejects, one without, and one that is refused."""
    run = SurveyRun(spark, scratch_path(spark, "staged"), "", "", {}, "b1", max_duplicate_share=1.0)
    copied, out = cleaning.copied_lines(spark, sf_dir), []

    def stage(step, rows, limit=1.0):
        run.max_duplicate_share = limit
        run.batch_id = "b2" if limit < 1 else "b1"
        refused = False
        try:
            write_staged(run, "lines", staging.deduplicate(rows, cleaning.LINE_KEY, cleaning.LINE_DATA, cleaning.PLACE))
        except DuplicateShareError:
            refused = True
        run.batch_id = "b1"
        out.append((step, run.staged("lines").count(), run.rejects("lines").count(), refused))

    stage("first", copied)
    kept = staging.deduplicate(copied, cleaning.LINE_KEY, cleaning.LINE_DATA, cleaning.PLACE).stored()
    stage("without repeats", kept)
    stage("too many duplicates", copied, 0.0)
    return spark.createDataFrame(out, "step string, staged long, rejects long, refused boolean")


# ---------- files ----------

def named_file(frame, path, encoding="UTF-8"):
    """A frame as one CSV file of a given name, whatever the file system."""
    spark = frame.sparkSession
    folder = scratch_path(spark, "part")
    frame.coalesce(1).write.option("header", True).option("encoding", encoding).csv(folder)
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = named.getFileSystem(spark._jsc.hadoopConfiguration())
    part = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "part-*"))[0].getPath()
    system.mkdirs(named.getParent())
    system.delete(named, False)
    system.rename(part, named)


@query("file_manifest", """
    WITH parts AS (
        SELECT 'customers' AS "table", lower(c_mktsegment) || '.csv' AS file, c_custkey AS k, c_custkey || ',' || c_name AS line,
               'c_custkey,c_name' AS header FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE', 'MACHINERY')
        UNION ALL SELECT 'codebook_nations', 'nations.csv', n_nationkey, n_nationkey || ',' || n_name, 'n_nationkey,n_name' FROM nation)
    SELECT "table", file, CASE WHEN file = 'machinery.csv' THEN 'latin-1' ELSE 'utf-8-sig' END AS encoding,
           count(*) AS data_lines, 2 AS columns, file = 'furniture.csv' AS changed_since_last_run,
           CASE WHEN file <> 'machinery.csv'
                THEN sha256(any_value(header) || chr(10) || string_agg(line || chr(10), '' ORDER BY k)) END AS sha256
    FROM parts GROUP BY "table", file""")
def file_manifest(spark, sf_dir):
    """Three part files, one in latin-1 and one changed since it was registered, and a codebook."""
    root = scratch_path(spark, "registered")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")

    def part(segment, rows, encoding="UTF-8"):
        lines = rows.where(F.col("c_mktsegment") == segment).drop("c_mktsegment").orderBy("c_custkey")
        named_file(lines, f"{root}/customers/{segment.lower()}.csv", encoding)

    part("BUILDING", customers)
    part("FURNITURE", customers.where("c_custkey % 2 = 0"))
    part("MACHINERY", customers.withColumn("c_name", F.concat("c_name", F.lit("\u00e9"))), "ISO-8859-1")
    named_file(read(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey"), f"{root}/nations.csv")
    registered = {"customers": f"{root}/customers", "codebook_nations": f"{root}/nations.csv"}
    before = checkpointed(files.file_manifest(spark, registered, "survey"))
    part("FURNITURE", customers)
    manifest = files.file_manifest(spark, registered, "survey", before)
    return manifest.select("table", "file", "encoding", "data_lines", "columns", "changed_since_last_run",
                           F.when(F.col("encoding") == "utf-8-sig", F.col("sha256")).alias("sha256"))


@query("file_lookup", """
    SELECT pattern, CASE count(segment) WHEN 0 THEN 'nothing' WHEN 1 THEN max(segment) || '.csv' ELSE 'several' END AS found
    FROM (VALUES ('auto*', 'auto%'), ('B*.CSV', 'b%.csv'), ('*e*.csv', '%e%.csv'), ('customers*', 'customers%')) p(pattern, likes)
    LEFT JOIN (SELECT DISTINCT c_mktsegment AS segment FROM customer) ON lower(segment) || '.csv' LIKE likes
    GROUP BY pattern""")
def file_lookup(spark, sf_dir):
    """Which entry of a folder a pattern names, if it names just one."""
    root, customers = scratch_path(spark, "segments"), read(spark, sf_dir, "customer")
    for (segment,) in customers.select("c_mktsegment").distinct().collect():
        named_file(customers.where(F.col("c_mktsegment") == segment), f"{root}/{segment}.csv")

    def found(pattern):
        try:
            return files.find_source(spark, root, pattern).rsplit("/", 1)[-1]
        except SourceError as missed:
            return "nothing" if "nothing" in str(missed) else "several"

    patterns = ["auto*", "B*.CSV", "*e*.csv", "customers*"]
    return spark.createDataFrame([(pattern, found(pattern)) for pattern in patterns], "pattern string, found string")


@query("manifest_diff", """
    SELECT doc_id AS "table", doc_id % 3 <> 0 AND doc_id % 5 = 0 AND upper(text) <> text AS changed_since_last_run
    FROM documents""")
def manifest_diff(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    current = documents.select(F.col("doc_id").alias("table"), F.sha2("text", 256).alias("sha256"))
    older = F.when(F.col("doc_id") % 5 == 0, F.upper("text")).otherwise(F.col("text"))
    previous = documents.where("doc_id % 3 <> 0").select(F.col("doc_id").alias("table"), F.sha2(older, 256).alias("sha256"))
    return files.flag_changes(current, previous).select("table", "changed_since_last_run")


# Records per JSON array file.
ARRAY_RECORDS = 20_000


def write_record_arrays(records, path):
    """Records as files holding one JSON array each, of a bounded number of records."""
    part = F.floor(F.col("code").cast("long") / ARRAY_RECORDS)
    arrays = records.groupBy(part).agg(F.to_json(F.collect_list(F.struct(*records.columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@query("json_dimension_scan", RECORDS_SQL)
def json_dimension_scan(spark, sf_dir):
    path = scratch_path(spark, "records")
    write_record_arrays(region_records(spark, sf_dir), path)
    regions = region_list.read_region_list(spark, path)
    region_list.check_region_list(regions)
    return regions


@query("dimension_snapshot", f"SELECT *, 'cached' AS status FROM ({RECORDS_SQL})")
def dimension_snapshot(spark, sf_dir):
    path = scratch_path(spark, "records")
    write_record_arrays(region_records(spark, sf_dir), f"{path}/fresh")
    write_record_arrays(region_records(spark, sf_dir).withColumn("name", F.lit(None).cast("string")), f"{path}/broken")
    region_list.load_region_list(spark, f"{path}/fresh", f"{path}/snapshot")
    return region_list.load_region_list(spark, f"{path}/broken", f"{path}/snapshot")
