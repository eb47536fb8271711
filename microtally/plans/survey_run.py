"""The whole run: source files to published tables, estimates and reports.

Each stage reads what earlier stages wrote and writes its own layer, so a run can be
resumed at any stage and a lost executor costs at most the tasks it was running.
"""

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from microtally.contract import SURVEY_CONTRACT
from microtally.operators import curate, estimates, formats, load, profiling, quality, raw_gate, rates, staging
from microtally.operators.joins import check_counts
from microtally.functions.text import blank_to_null
from microtally.session import in_parallel, path_exists
from microtally.settings import DEMO_REGION, MIN_REGIONS, PARTITION_COLUMN, SURVEY_FILES, SURVEY_YEAR
from microtally.sources import codebook, datasets, files, region_list, text_tables

# Codebooks stand in the manifest under this and the name of their source.
CODEBOOK_PREFIX = "codebook_"

CURATED = ["dim_region", "household", "member", "literacy_assessment", "agg_literacy_digital"]


@dataclass
class SurveyRun:
    """Where a run reads and writes.

    ``raw`` holds the survey files, ``regions`` is the JSON region list, ``sheets`` maps
    codebook sources to CSV exports with the cells ``c0`` to ``c4``. All paths must be
    reachable by every executor.
    """

    spark: SparkSession
    root: str
    raw: str
    regions: str
    sheets: dict
    batch_id: str
    source: str = "survey"
    year: int = SURVEY_YEAR
    contract: dict = field(default_factory=lambda: SURVEY_CONTRACT)
    min_regions: int = MIN_REGIONS
    demo_region: int = DEMO_REGION
    max_duplicate_share: float = staging.MAX_DUPLICATE_SHARE
    keep_as_text: dict = field(default_factory=dict)

    def path(self, layer: str, name: str = "") -> str:
        return f"{self.root}/{layer}/{name}".rstrip("/")

    def staged_path(self, name: str) -> str:
        return self.path("staging", f"{name}/batch={self.batch_id}")

    def staged(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.staged_path(name))

    def rejects(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("staging_rejects", f"{name}/batch={self.batch_id}"))

    def curated(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("curated", name))

    def manifest(self) -> DataFrame:
        return self.spark.read.json(self.path("manifests", f"batch={self.batch_id}"))

    def locate(self, table: str) -> str:
        return files.find_source(self.spark, self.raw, SURVEY_FILES[table]["file_pattern"])

    def registered(self) -> list:
        """Per table: where it is, its encoding and its number of data lines."""
        surveyed = self.manifest().where(F.col("table").isin(list(SURVEY_FILES)))
        rows = surveyed.groupBy("table", "location").agg(
            files.common_encoding(), F.sum("data_lines").alias("data_lines")
        )
        return sorted(rows.collect(), key=lambda row: list(SURVEY_FILES).index(row.table))

    # ---------- stages ----------

    def fetch_regions(self) -> int:
        """Take the region list, or its last good snapshot."""
        regions = region_list.load_region_list(
            self.spark, self.regions, self.path("raw", "regions_snapshot"), minimum=self.min_regions
        )
        datasets.write_table(regions, self.path("raw", "regions"))
        return self.spark.read.parquet(self.path("raw", "regions")).count()

    def ingest(self) -> int:
        """Register the source files and the codebooks; all must be there before any is read."""
        paths = {table: self.locate(table) for table in SURVEY_FILES}
        paths |= {f"{CODEBOOK_PREFIX}{source}": path for source, path in self.sheets.items()}
        previous = self._previous_manifest()
        manifest = files.file_manifest(self.spark, paths, self.source, previous).withColumn(
            "ingested_at", F.current_timestamp()
        )
        target = self.path("manifests", f"batch={self.batch_id}")
        manifest.coalesce(1).write.mode("overwrite").json(target)
        registered = files.reject_empty(self.manifest()).where(F.col("table").isin(list(SURVEY_FILES)))
        return registered.select("table").distinct().count()

    def _previous_manifest(self) -> DataFrame | None:
        """The last registered state of each table."""
        if not path_exists(self.spark, self.path("manifests")):
            return None
        history = self.spark.read.json(self.path("manifests"))
        earlier = history.where(F.col("batch").cast("string") != self.batch_id)
        return earlier.groupBy("table", "file").agg(F.max_by("sha256", "ingested_at").alias("sha256"))

    def validate_raw(self) -> list:
        registered = self.path("manifests", f"batch={self.batch_id}")
        manifest = self.manifest() if path_exists(self.spark, registered) else None
        results = raw_gate.check_raw_files(self.spark, self.locate, self.contract["raw_files"], manifest)
        if manifest is not None:
            books = {f"{CODEBOOK_PREFIX}{source}": path for source, path in self.sheets.items()}
            quality.raise_if_failed("codebooks", raw_gate.check_registered(self.spark, books, manifest))
        return self._report("raw_gate", results)

    def profile(self) -> list[str]:
        return in_parallel(self.spark, self._profile_table, self.registered())

    def _profile_table(self, row) -> str:
        raw = text_tables.read_text_table(self.spark, row.location, row.encoding)
        report = profiling.full_profile(raw, row.table, row.location.rsplit("/", 1)[-1])
        report.coalesce(1).write.mode("overwrite").json(self.path("reports/profile", row.table))
        return row.table

    def stage(self) -> dict[str, int]:
        stats = in_parallel(
            self.spark, lambda row: stage_table(self, row.table, row.location, row.encoding), self.registered()
        )
        columns = "`table` string, rows_in long, exact_duplicates_removed long, rows_sharing_a_key long, " \
                  "key_duplicates_removed long, rows_out long, typed_columns long, key array<string>, output string, " \
                  "codebook_labels long"
        self._stage_codebook()
        labels = self.staged("codebook").count()
        report = self.spark.createDataFrame(
            [(*s.values(), SURVEY_FILES[s["table"]]["key"], self.staged_path(s["table"]), labels) for s in stats], columns)
        report.coalesce(1).write.mode("overwrite").json(self.path("reports/dedup", f"batch={self.batch_id}"))
        return {s["table"]: s["rows_out"] for s in stats}

    def _stage_codebook(self) -> None:
        sheets = {source: read_sheet(self.spark, path) for source, path in self.sheets.items()}
        book = codebook.parse_codebook(codebook.union_sheets(sheets))
        datasets.write_table(book, self.staged_path("codebook"))

    def validate_staging(self) -> list:
        lines = {row.table: row.data_lines for row in self.registered()}
        report = self.spark.read.json(self.path("reports/dedup", f"batch={self.batch_id}")).collect()
        reconciled = [
            quality.check_row_reconciliation(
                row.table, lines[row.table], row.rows_out, row.exact_duplicates_removed + row.key_duplicates_removed
            )
            for row in report
        ]
        tables = {name: self.staged(name) for name in SURVEY_FILES}
        return self._validate("staging", tables, reconciled)

    def curate(self) -> dict[str, int]:
        """Write the curated tables; each is built from what is already written."""
        book = self.staged("codebook")
        arguments = (book, self.year, self.batch_id)
        build = {
            "dim_region": lambda: curate.build_dim_region(self.spark.read.parquet(self.path("raw", "regions"))),
            "household": lambda: curate.build_household(
                self.staged("v1_household"), self.staged("v1_household_questions"), *arguments),
            "member": lambda: curate.build_member(self.staged("v1_member"), *arguments),
            "literacy_assessment": lambda: curate.build_assessment(self.staged("v1_literacy"), *arguments),
        }
        written = in_parallel(self.spark, lambda name: self._write(build[name](), self.path("curated", name)), build)
        counts = dict(zip(build, written))
        profile = curate.build_person_profile(
            self.curated("household"), self.curated("member"), self.curated("literacy_assessment"),
            self.curated("dim_region"),
        )
        counts["person_profile"] = self._write_profile(profile)
        check_counts("person_profile", counts["member"], counts["person_profile"])
        aggregate = curate.build_aggregate(self.person_profile(), self.year, self.batch_id)
        counts["agg_literacy_digital"] = self._write(aggregate, self.path("curated", "agg_literacy_digital"))
        datasets.write_csv_copy(self.curated("agg_literacy_digital"), self.path("published", "agg_literacy_digital_csv"), one_file=True)
        return counts

    def person_profile(self, region_code=None) -> DataFrame:
        return datasets.read_partitioned(self.spark, self.path("curated", "person_profile"), region_code)

    def validate_curated(self) -> list:
        tables = {name: self.curated(name) for name in CURATED}
        tables["person_profile"] = self.person_profile()
        return self._validate("curated", tables)

    def load(self) -> dict[str, int]:
        tables = {name: self.curated(name) for name in CURATED}
        return load.load_tables(
            self.spark, self.path("warehouse"), tables, self.batch_id, self.year,
            rules=load.load_rules(self.contract), types=load.DECLARED)

    def compare_formats(self) -> int:
        """Sizes and changed types per format, and what reading one region saves."""
        folder = self.path("formats")
        fidelity = formats.format_fidelity(self.person_profile(), folder)
        report = fidelity.join(formats.format_sizes(self.spark, folder), "format")
        report.coalesce(1).write.mode("overwrite").json(self.path("reports/formats", f"batch={self.batch_id}"))
        dataset = self.spark.read.parquet(self.path("curated", "person_profile"))
        pruning = formats.pruning_report(dataset, self.demo_region)
        pruning.coalesce(1).write.mode("overwrite").json(self.path("reports/pruning", f"batch={self.batch_id}"))
        return len(formats.WRITERS)

    def estimate(self) -> int:
        table = estimates.key_indicators(
            self.curated("household"), self.curated("literacy_assessment"), self.curated("dim_region"), self.batch_id
        )
        datasets.write_table(table.coalesce(1), self.path("published", "key_estimates"))
        saved = self.published("key_estimates")
        datasets.write_csv_copy(saved, self.path("published", "key_estimates_csv"), one_file=True)
        return saved.count()

    def published(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("published", name))

    def chart_tables(self) -> list[str]:
        """The data behind the three charts."""
        saved = self.published("key_estimates")
        tables = {
            "literacy_by_tier": estimates.tier_table(saved),
            "internet_by_region": estimates.region_table(saved),
            "sample_sizes": rates.sample_sizes(self.curated("agg_literacy_digital"), self.curated("dim_region")),
        }
        for name, table in tables.items():
            datasets.write_csv_copy(table, self.path("published/charts", name), one_file=True)
        return list(tables)

    # ---------- helpers ----------

    def _write(self, df: DataFrame, path: str) -> int:
        seen = Observation()
        datasets.write_table(df.observe(seen, F.count("*").alias("rows")), path)
        return seen.get["rows"]

    def _write_profile(self, profile: DataFrame) -> int:
        seen = Observation()
        datasets.write_partitioned(
            profile.observe(seen, F.count("*").alias("rows")), self.path("curated", "person_profile"),
            PARTITION_COLUMN, ["hhid", "line_no"],
        )
        return seen.get["rows"]

    def _validate(self, stage: str, tables: dict, extra=()) -> list:
        try:
            results = quality.run_validation(stage, tables, self.contract, extra)
        except quality.DataQualityError as failure:
            quality.write_report(self.spark, self.path("reports/validation"), stage, self.batch_id, failure.results)
            raise
        quality.write_report(self.spark, self.path("reports/validation"), stage, self.batch_id, results)
        return results

    def _report(self, stage: str, results: list) -> list:
        quality.write_report(self.spark, self.path("reports/validation"), stage, self.batch_id, results)
        return quality.raise_if_failed(stage, results)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A codebook sheet export: cells as text, blank cells null, rows numbered."""
    rows = text_tables.read_numbered_table(spark, path)
    cells = [blank_to_null(F.col(name)).alias(name) for name in ("c0", "c1", "c2", "c3", "c4")]
    return rows.select(F.col("source_line").alias("row"), *cells)


def stage_table(run: SurveyRun, table: str, path: str, encoding: str) -> dict:
    """Clean, number, type and de-duplicate one file in two scans; returns its counts.

    The first scan counts the rows of every file block and decides all column types; the
    second one does the rest. Survivors and counts come from one job.
    """
    spark, key = run.spark, SURVEY_FILES[table]["key"]
    scanned = text_tables.scan_blocks(spark, path, encoding)
    marks = [text_tables.FILE, text_tables.BLOCK, text_tables.ROW, "source_file"]
    names = [name for name in scanned.columns if name not in marks]
    typed_names = [name for name in names if name not in run.keep_as_text.get(table, ())]
    clean = scanned.select(*[blank_to_null(F.col(f"`{name}`")).alias(name) for name in names], *marks)
    kinds = staging.with_kinds(clean.select(*typed_names, *marks), typed_names)
    blocks = text_tables.block_facts(kinds, *staging.type_counters(typed_names))
    types = staging.decide_types(staging.add_up(blocks).first().asDict(), typed_names)
    typed = staging.apply_types(text_tables.number_rows(clean, blocks), types)
    return {**write_staged(run, table, staging.deduplicate(typed, key, names), whole=True), "typed_columns": len(types)}


def write_staged(run: SurveyRun, table: str, deduplicated: staging.Deduplicated, whole: bool = False) -> dict:
    """Write survivors, their counts and the rejects of one table.

    A batch writes into its own folder, so one that is stopped for too many duplicates
    replaces nothing. A large table is worked on in parts, unless it must be ``whole``, like text
    that is dear to parse once more.
    """
    parts = [deduplicated] if whole else deduplicated.parts()
    seen = [Observation() for _ in parts]
    ingested_at = F.lit(datetime.now(timezone.utc))
    kept = [
        part.survivors(part.firsts.observe(counted, *staging.first_counters()))
        .withColumn("batch_id", F.lit(run.batch_id)).withColumn("ingested_at", ingested_at)
        for part, counted in zip(parts, seen)
    ]
    datasets.write_parts(kept, run.staged_path(table))
    counts = [counted.get for counted in seen]
    rows_in, shared_keys, rows_out = (sum(count[name] for count in counts) for name in ("rows_in", "shared_keys", "rows_out"))
    staging.check_duplicate_share(table, {"rows_in": rows_in, "rows_out": rows_out}, run.max_duplicate_share)
    sharing = [(part.rejects, Observation()) for part, count in zip(parts, counts) if count["shared_keys"]]
    rejects = [rows.observe(counted, F.count("*").alias("rows")) for rows, counted in sharing]
    datasets.write_parts(rejects or [deduplicated.rejects.limit(0)], run.path("staging_rejects", f"{table}/batch={run.batch_id}"))
    rejected = sum(counted.get["rows"] for _, counted in sharing)
    repeats = rejected - shared_keys
    return {
        "table": table, "rows_in": rows_in, "exact_duplicates_removed": rows_in - rows_out - repeats,
        "rows_sharing_a_key": rejected, "key_duplicates_removed": repeats, "rows_out": rows_out,
    }


# Stage names in their order; each needs the ones before it.
STAGES = {
    "fetch_regions": SurveyRun.fetch_regions,
    "ingest": SurveyRun.ingest,
    "validate_raw": SurveyRun.validate_raw,
    "profile": SurveyRun.profile,
    "staging": SurveyRun.stage,
    "validate_staging": SurveyRun.validate_staging,
    "curated": SurveyRun.curate,
    "validate_curated": SurveyRun.validate_curated,
    "load": SurveyRun.load,
    "formats": SurveyRun.compare_formats,
    "estimates": SurveyRun.estimate,
    "charts": SurveyRun.chart_tables,
}


def run_survey(run: SurveyRun, stages=None) -> dict:
    """Run all stages, or the named ones in their order; the first failure stops the run."""
    unknown = set(stages or ()) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    return {name: stage(run) for name, stage in STAGES.items() if not stages or name in stages}
