"""Publishing curated tables: replace one survey year, upsert a lookup, audit the load.

A load writes each table into folders of its own run and then appends one audit row. The
audit row publishes it: readers take, per survey year, the folders of the latest run
listed there. A load that fails half-way has no audit row and stays invisible, other years
are never touched, and loading a batch again replaces its year instead of doubling it.
Folders of replaced runs stay until somebody removes those :func:`unpublished_runs` lists. Two loads
at once cannot take the same folder: the second one fails.
"""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from microtally.contract import SURVEY_CONTRACT
from microtally.errors import JoinContractError
from microtally.operators import quality
from microtally.operators.joins import unique_by
from microtally.session import path_exists
from microtally.settings import LOAD_PLAN, SURVEY_YEAR

AUDIT_SCHEMA = (
    "run_id long, batch_id string, survey_year int, started_at timestamp, finished_at timestamp, row_counts string"
)


# ---------- frame level ----------

def tag_batch(df: DataFrame, batch_id: str) -> DataFrame:
    """Name the loading batch in tables that record one."""
    return df.withColumn("batch_id", F.lit(batch_id)) if "batch_id" in df.columns else df


def replace_period(old: DataFrame, new: DataFrame, column: str, value) -> DataFrame:
    """Rows of all other periods, and the new rows of this one."""
    other = F.coalesce(F.col(column) != value, F.lit(True))
    return old.where(other).unionByName(new)


def upsert(old: DataFrame, new: DataFrame, key) -> DataFrame:
    """Insert new rows; a row whose key exists replaces the old one.

    A key that occurs twice among the new rows fails the job.
    """
    new = unique_by(new, key, "upsert")
    return old.join(new.select(*key), list(key), "left_anti").unionByName(new)


def overwrite_periods(df: DataFrame, path: str, column: str) -> None:
    """Rewrite just the partitions that occur in ``df``; others stay as they are."""
    (
        df.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


# ---------- warehouse ----------

def table_path(root: str, table: str, run_id: int) -> str:
    return f"{root}/{table}/run_id={run_id}"


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """All loads that succeeded."""
    path = f"{root}/pipeline_run"
    if not path_exists(spark, path):
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return spark.read.schema(AUDIT_SCHEMA).json(path)


def current_runs(spark: SparkSession, root: str) -> list[int]:
    """Runs whose data are visible: the latest of each survey year."""
    latest = read_audit(spark, root).groupBy("survey_year").agg(F.max("run_id").alias("run_id"))
    return sorted(row.run_id for row in latest.collect())


def read_warehouse(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The published rows of a table: one folder per visible run, or the newest lookup."""
    runs = current_runs(spark, root)
    upserted = {item["table"] for item in LOAD_PLAN if item["strategy"] == "upsert"}
    folders = [table_path(root, table, run) for run in (runs[-1:] if table in upserted else runs)]
    return spark.read.parquet(*folders)


# Columns of a loaded table that identify a row beside its primary key.
ALSO_UNIQUE = {"dim_region": [["psgc_code"]]}

# Declared types of loaded columns that differ from those of the curated tables.
DECLARED = {
    "survey_year": "smallint", "region_code": "smallint", "region_code_nir": "smallint", "province_code": "smallint",
    "line_no": "smallint", "age": "smallint", "relationship_code": "smallint", "education_level_code": "smallint",
    "result_code": "smallint", "functional_literacy_level_code": "smallint", "digital_access_score": "smallint",
    "persons_sampled": "int", "psu": "int", "functional_literacy_rate": "decimal(5,2)", "basic_literacy_rate": "decimal(5,2)",
}


def load_rules(contract: dict) -> dict:
    """What a table must hold to be published: the contract, and all keys unique."""
    return {item["table"]: contract["tables"][item["table"]] for item in LOAD_PLAN}


def default_rules(plan) -> dict:
    """The published contract of those tables of a plan that it describes."""
    described = SURVEY_CONTRACT["tables"]
    return {item["table"]: described[item["table"]] for item in plan if item["table"] in described}


def declared_types(df: DataFrame, types) -> DataFrame:
    """The columns under their declared types; a value that does not fit fails the job."""
    return df.select(*[F.col(name).cast(types[name]) if name in types else F.col(name) for name in df.columns])


def check_rules(tables: dict, rules: dict) -> list:
    """Checks of the tables about to be published; an error among them stops the load."""
    results = []
    for table, spec in rules.items():
        results += quality.validate_table(tables[table], table, spec, tables)
        for key in ALSO_UNIQUE.get(table, []):
            repeats = quality.rows_sharing_keys(tables[table].dropna(subset=key), key).first().failing_rows
            results.append(quality.result(table, "unique", ",".join(key), repeats, f"{repeats:,} rows with a repeated key"))
    return quality.raise_if_failed("load", results)


def load_tables(spark: SparkSession, root: str, tables: dict, batch_id: str, year: int = SURVEY_YEAR,
                plan=LOAD_PLAN, rules: dict | None = None, types: dict | None = None) -> dict[str, int]:
    """Write all tables of the plan, then publish them together with one audit row.

    Columns get their declared ``types``. ``rules`` are checked on what was written, before the audit row publishes
    it: those of the contract unless others are given, none if they are empty. So each table is made once, and what
    is checked is what readers get. A folder that another load has taken in the meantime fails this one.
    """
    started = datetime.now(timezone.utc)
    missing = [item["table"] for item in plan if item["table"] not in tables]
    if missing:
        raise JoinContractError(f"tables to load are missing: {missing}")
    run_id = _next_run(spark, root, plan)
    counts = {}
    for item in plan:
        table = item["table"]
        rows = declared_types(tag_batch(tables[table], batch_id), types or {})
        if item["strategy"] == "upsert":
            rows = _merge_lookup(spark, root, table, rows, item["key"])
        else:
            rows = rows.where(_one_year(rows, table, year))
        counts[table] = _write_counted(rows, table_path(root, table, run_id))
    rules = default_rules(plan) if rules is None else rules
    if rules:
        check_rules({table: spark.read.parquet(table_path(root, table, run_id)) for table in counts}, rules)
    append_audit(spark, root, run_id, batch_id, year, started, counts)
    return counts


def _next_run(spark: SparkSession, root: str, plan) -> int:
    """A number no load has used, published or not."""
    last = read_audit(spark, root).agg(F.max("run_id")).first()[0] or 0
    run_id = last + 1
    while any(path_exists(spark, table_path(root, item["table"], run_id)) for item in plan):
        run_id += 1
    return run_id


def unpublished_runs(spark: SparkSession, root: str, plan=LOAD_PLAN) -> list[str]:
    """Folders no reader sees: of loads that failed, and of runs that were replaced."""
    seen, found = set(current_runs(spark, root)), []
    for item in plan:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{item['table']}/run_id=*")
        for entry in folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or []:
            run = int(entry.getPath().getName().split("=")[1])
            if run not in seen:
                found.append(entry.getPath().toString())
    return sorted(found)


def _merge_lookup(spark, root, table, rows, key):
    if not current_runs(spark, root):
        return unique_by(rows, key, table)
    return upsert(read_warehouse(spark, root, table), rows, key)


def _one_year(rows, table, year):
    """All rows pass; one of another survey year fails the job."""
    message = F.lit(f"{table}: row outside survey year {year}")
    return F.when(F.col("survey_year") == year, True).otherwise(F.raise_error(message).cast("boolean"))


def _write_counted(rows: DataFrame, path: str) -> int:
    """Write and count in one job."""
    seen = Observation()
    rows.observe(seen, F.count("*").alias("rows")).write.mode("errorifexists").parquet(path)
    return seen.get["rows"]


def append_audit(spark: SparkSession, root: str, run_id: int, batch_id: str, year: int, started: datetime,
                 counts: dict) -> None:
    """One row per successful load, with the row counts as a JSON document."""
    counted = F.create_map(*[F.lit(item) for pair in counts.items() for item in pair])
    row = spark.range(1).select(
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(year).cast("int").alias("survey_year"),
        F.lit(started).cast("timestamp").alias("started_at"),
        F.current_timestamp().alias("finished_at"),
        F.to_json(counted).alias("row_counts"),
    )
    row.coalesce(1).write.mode("append").json(f"{root}/pipeline_run")


def load_history(audit: DataFrame, limit: int = 5, counted: str = "member") -> DataFrame:
    """The latest loads, newest first, with the row count of one table as text."""
    return (
        audit.orderBy(F.desc("run_id"))
        .limit(limit)
        .select("run_id", "batch_id", "finished_at", F.get_json_object("row_counts", f"$.{counted}").alias("member_rows"))
    )


def to_second(timestamp):
    """Round a timestamp to the nearest second."""
    return F.date_trunc("second", timestamp + F.expr("INTERVAL '0.5' SECOND"))
