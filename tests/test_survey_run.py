"""A whole run on generated survey files: layers, gates, reload, failures."""

import json
import random
import shutil
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from microtally.contract import SURVEY_CONTRACT, without_minimums
from microtally.errors import DataQualityError, DuplicateShareError
from microtally.operators import load, rates, staging
from microtally.plans.survey_run import STAGES, SurveyRun, run_survey, write_staged
from microtally.sources import datasets

HOMES = 120
REGIONS = [1, 2, 3, 13]


def survey_files(folder):
    """Files with the known quirks: mixed padding, blanks, age 99, zero weights, a code without label."""
    rng = random.Random(5)
    folder.mkdir(parents=True, exist_ok=True)
    homes, questions, members, tests = [], [], [], []
    for hhid in range(1, HOMES + 1):
        region = rng.choice(REGIONS)
        weight = round(rng.uniform(1, 900), 4)
        homes.append(f"{hhid:06d},{region:02d},{region:02d},{region * 100 + 1},{rng.choice([1, 2, 3])},{hhid % 9},1,{weight}")
        answers = ",".join(str(rng.choice([1, 2])) for _ in range(10))
        questions.append(f"{hhid:>6},{region},{answers},{weight}")
        for line in range(1, rng.randint(2, 6)):
            age = rng.choice([3, 7, 12, 20, 40, 63, 80, 99])
            members.append(f"{hhid}, {line},{rng.choice([1, 2])},{age},{line},{rng.choice(['', '0', '1', '8'])},"
                           f"{rng.choice(['', '1', '4'])},{round(rng.uniform(1, 50), 3)}")
            if age >= 5:
                result = rng.choice([1, 1, 1, 4])
                flags = ",".join(rng.choice(["", "1", "2"]) for _ in range(7))
                outcome = ",".join(rng.choice(["1", "2"]) for _ in range(2)) if 10 <= age <= 64 and result == 1 else ","
                tests.append(f"{hhid},{line},{result},{age},{flags},{rng.choice(['', '0', '3'])},{outcome},"
                             f"{round(rng.uniform(1, 70), 3) if result == 1 else 0}")
    text = {
        "Volume1 Household.CSV": ["HHID,REG,REG2,PRV,URBANITY,PSU,INTVW,RFACT", *homes],
        "volume1_RTF1.csv": ["HHID,REG,BENEFICIARY_4PS,ELECTRICITY,HH_SMARTPHONE,HH_BASICPHONE,HH_PC,HH_TABLET,HH_CABNET,"
                             "HH_NOCABNET,HH_MOBSUB,ICT_EQUIP,HH_RFACT", *questions],
        "Volume1_Member.csv": ["HHID,LNO,SEX,AGE,REL,HGC_LEVEL,ATTEND_SCHOOL,MEM_RFACT", *members],
        "volume1 RTF2.csv": ["HHID,LNO_F2,RESULT_CODE_F2,AGE_F2,READING,READING59,WRITING,WRITING59,COMPUTE,COMPUTE59,"
                             "COMPRE,FLLEVEL,BLITERATE,FLITERATE,RESP_RFACT_F2", *tests],
    }
    for name, lines in text.items():
        (folder / name).write_bytes(("﻿" + "\n".join(lines) + "\n").encode("utf-8"))
    return {name: len(lines) - 1 for name, lines in text.items()}


LABELS = {
    "URBANITY": {1: "1 - Urban", 2: "2 - Rural", 3: "3 - No official classification"},
    "SEX": {1: "1 - Male", 2: "2 - Female"},
    "HGC_LEVEL": {0: "0 - No grade", 1: "1 - Elementary", 8: "8 - Doctorate"},
    "RESULT_CODE_F2": {1: "01 - Completed Interview", 4: "04 - Refusal"},
    "FLLEVEL": {0: "0 - Illiterate", 3: "3 - Functional Literate"},
}


def inputs(folder):
    counts = survey_files(folder / "files")
    sheet = ["c0,c1,c2,c3,c4"]
    for variable, labels in LABELS.items():
        sheet.append(f"{variable}_VS1,{variable.title()},,,")
        sheet += [f",,{label},{code}," for code, label in labels.items()]
    (folder / "sheet.csv").write_text("\n".join(sheet) + "\n")
    regions = [
        {"code": f"r{n}", "name": f"Name {n}", "regionName": f"Region {n}" if n < 13 else "Capital",
         "islandGroupCode": "luzon", "psgc10DigitCode": f"{n:02d}00000000"} for n in range(1, 18)]
    (folder / "regions.json").write_text(json.dumps(regions))
    return counts


def survey(spark, folder, root, batch, **changes):
    return SurveyRun(
        spark=spark, root=str(root), raw=str(folder / "files"), regions=str(folder / "regions.json"),
        sheets={"survey": str(folder / "sheet.csv")}, batch_id=batch,
        **{"contract": without_minimums(SURVEY_CONTRACT), **changes})


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    counts = inputs(folder)
    run = survey(spark, folder, folder / "out", "b1")
    return run, run_survey(run), counts, folder


def test_every_stage_reports(finished):
    run, report, counts, _ = finished
    assert list(report) == list(STAGES)
    assert report["fetch_regions"] == 17 and report["ingest"] == 4
    assert list(report["staging"].values()) == list(counts.values())
    assert report["curated"]["person_profile"] == counts["Volume1_Member.csv"] == report["load"]["member"]
    assert report["curated"]["literacy_assessment"] == counts["volume1 RTF2.csv"]


def test_gates_ran_the_published_number_of_checks(finished):
    _, report, _, _ = finished
    assert [len(report[gate]) for gate in ("validate_raw", "validate_staging", "validate_curated")] == [26, 117, 177]
    assert all(r.passed for gate in ("validate_raw", "validate_staging", "validate_curated") for r in report[gate])


def test_one_record_can_be_traced_to_its_line(finished):
    run, _, _, folder = finished
    row = run.staged("v1_member").where("hhid = 7 AND lno = 2").first()
    line = (folder / "files" / row.source_file).read_text("utf-8-sig").splitlines()[row.source_line - 1]
    assert [int(cell) for cell in line.split(",")[:4]] == [7, 2, row.sex, row.age]
    person = rates.trace_record(run.person_profile(), 7, 2).first()
    assert person.sex == {1: "Male", 2: "Female"}[row.sex]
    assert person.age == (None if row.age == 99 else row.age)


def test_profile_has_its_columns_and_partitions(finished):
    run, _, _, _ = finished
    profile = run.person_profile()
    assert len(profile.columns) == 29
    assert run.person_profile(13).count() == profile.where("region_code = 13").count() > 0


def test_queries_run_as_sql_on_the_warehouse(finished, spark):
    run, _, counts, _ = finished
    root = run.path("warehouse")
    names = ["dim_region", "household", "member", "literacy_assessment", "agg_literacy_digital"]
    rates.register_views({name: load.read_warehouse(spark, root, name) for name in names})
    tiers = spark.sql("""
        WITH assessed AS (
            SELECT digital_access_tier AS tier, digital_access_score AS score, functional_literate AS literate,
                   respondent_weight AS w
            FROM literacy_assessment JOIN household USING (survey_year, hhid))
        SELECT tier, count(literate), round(100 * sum(w) FILTER (WHERE literate) / sum(w) FILTER (WHERE literate IS NOT NULL), 1)
        FROM assessed WHERE literate IS NOT NULL GROUP BY tier ORDER BY min(score)""").collect()
    ours = rates.rate_by_tier(spark.table("literacy_assessment"), spark.table("household")).collect()
    assert [(r[0], r[1], float(r[2])) for r in tiers] == [tuple(r) for r in ours]
    assert spark.sql("SELECT * FROM v_person_profile WHERE hhid = 7 AND line_no = 2").count() == 1
    assert spark.table("v_person_profile").count() == counts["Volume1_Member.csv"]


def test_rerun_changes_no_counts(finished, spark):
    run, report, _, folder = finished
    again = survey(spark, folder, run.root, "b2")
    second = run_survey(again, ["ingest", "staging", "curated", "load"])
    assert second["staging"] == report["staging"] and second["load"] == report["load"]
    assert not any(row.changed_since_last_run for row in again.manifest().collect())
    rows = load.read_warehouse(spark, run.path("warehouse"), "member")
    assert rows.count() == report["load"]["member"]
    assert {r.batch_id for r in rows.select("batch_id").distinct().collect()} == {"b2"}
    assert load.read_audit(spark, run.path("warehouse")).count() == 2


def test_estimates_and_chart_tables_are_published(finished, spark):
    run, report, _, _ = finished
    table = run.published("key_estimates")
    assert table.count() == report["estimates"] == 2 + 4 + 1 + 2 * len(REGIONS)
    charts = spark.read.option("header", True).csv(run.path("published/charts", "sample_sizes"))
    assert charts.columns[0] == "region" and charts.count() == len(REGIONS)


def test_format_and_pruning_reports(finished, spark):
    run, report, counts, _ = finished
    people = counts["Volume1_Member.csv"]
    formats = {r.format: r for r in spark.read.json(run.path("reports/formats")).collect()}
    assert set(formats) == {"csv", "json", "parquet"} and report["formats"] == 3
    assert all(r.rows == people and r.size_bytes > 0 for r in formats.values())
    assert formats["parquet"].changed_columns == 0 < formats["csv"].changed_columns
    pruning = {r.scope: r for r in spark.read.json(run.path("reports/pruning")).collect()}
    assert pruning["all"].rows == people and pruning["one partition"].files < pruning["all"].files


def broken(finished, tmp_path, name, change):
    folder = finished[3]
    copy = tmp_path / "inputs"
    shutil.copytree(folder, copy, ignore=shutil.ignore_patterns("out"))
    path = copy / "files" / name
    path.write_bytes(change(path.read_bytes()))
    return copy


def test_changed_file_stops_at_the_raw_gate(finished, spark, tmp_path):
    folder = broken(finished, tmp_path, "Volume1_Member.csv", lambda content: content)
    run = survey(spark, folder, tmp_path / "out", "b1")
    run_survey(run, ["ingest"])
    path = folder / "files" / "Volume1_Member.csv"
    path.write_bytes(path.read_bytes().replace(b"\n1, 1,", b"\n1,,"))
    with pytest.raises(DataQualityError) as failure:
        run_survey(run, ["validate_raw"])
    assert {r.check for r in failure.value.results if not r.passed} == {"checksum", "key_not_blank"}
    report = spark.read.json(run.path("reports/validation"))
    assert report.first().checks_failed == 2


def shuffle_files(spark):
    kept = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {kept.apply(i).getName() for i in range(kept.size()) if kept.apply(i).getName().startswith("shuffle_")}


def test_a_large_table_is_staged_in_parts_that_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "PART_FROM_BYTES", 0, raising=False)
    rows = [(i % 400, i % 3, "f", i) for i in range(2_000)] + [(None, 1, "f", 2_000), (None, 1, "f", 2_001)]
    spark.createDataFrame(rows, "k long, v long, source_file string, source_line long").write.parquet(str(tmp_path / "in"))
    table = spark.read.parquet(str(tmp_path / "in"))
    run = SurveyRun(spark, str(tmp_path / "out"), "", "", {}, "b1", max_duplicate_share=1.0)
    before = shuffle_files(spark)
    for _ in range(2):  # a batch replaces what it wrote
        stats = write_staged(run, "t", staging.deduplicate(table, ["k"], ["k", "v"]))
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert stats == {"table": "t", "rows_in": 2002, "exact_duplicates_removed": 801, "rows_sharing_a_key": 1200,
                     "key_duplicates_removed": 800, "rows_out": 401}
    assert run.staged("t").count() == run.staged("t").select("k").distinct().count() == 401
    assert run.staged("t").select("ingested_at").distinct().count() == 1
    assert run.rejects("t").count() == 1200 and run.rejects("t").where("k IS NULL").count() == 0


def test_a_table_of_which_a_part_failed_does_not_appear(spark, tmp_path):
    path = str(tmp_path / "tables/batch=b1")
    good, other = spark.range(5), spark.range(5, 9)
    datasets.write_parts([good, other], path)
    assert spark.read.parquet(path).count() == 9
    with pytest.raises(PySparkException, match="no more"):
        datasets.write_parts([good, other.withColumn("id", F.raise_error(F.lit("no more")).cast("long"))], path)
    assert [entry for entry in (tmp_path / "tables").iterdir() if not entry.name.startswith(".")] == []


def test_duplicates_are_rejected_or_stop_the_run(finished, spark, tmp_path):
    def repeat(content):
        lines = content.decode("utf-8").splitlines()
        exact, other = lines[1], lines[2].rsplit(",", 1)[0] + ",9.5"
        return "\n".join([*lines, exact, other, ""]).encode("utf-8")

    folder = broken(finished, tmp_path, "Volume1_Member.csv", repeat)
    stages = ["fetch_regions", "ingest", "staging"]
    with pytest.raises(DuplicateShareError, match="v1_member"):
        run_survey(survey(spark, folder, tmp_path / "strict", "b1", max_duplicate_share=0.001), stages)
    run = survey(spark, folder, tmp_path / "out", "b1", max_duplicate_share=0.05)
    run_survey(run, [*stages, "validate_staging"])
    stats = {r.table: r for r in spark.read.json(run.path("reports/dedup")).collect()}["v1_member"]
    assert (stats.exact_duplicates_removed, stats.key_duplicates_removed, stats.rows_sharing_a_key) == (1, 1, 2)
    assert run.rejects("v1_member").count() == 2 and run.rejects("v1_household").count() == 0
    assert run.staged("v1_member").where("mem_rfact = 9.5").count() == 0
