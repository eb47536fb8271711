"""Survey text files made from the test tables, as a run expects to find them."""

from pyspark.sql import functions as F

from workload import roles


def survey_tables(spark, sf_dir):
    """The staging roles, kept to what the contract allows."""
    homes = roles.staged(spark, sf_dir, "v1_household").withColumn("urbanity", F.col("hhid") % 3 + 1)
    questions = roles.staged(spark, sf_dir, "v1_household_questions")
    answers = [name for name in questions.columns if name not in ("hhid", "prv", "hh_rfact")]
    members = roles.staged(spark, sf_dir, "v1_member")
    tests = roles.staged(spark, sf_dir, "v1_literacy")
    # Orders become lines 1, 2, ... of their household.
    lines = "row_number() OVER (PARTITION BY hhid ORDER BY lno)"
    numbered = members.withColumn("line", F.expr(lines))
    return {
        "v1_household": homes,
        "v1_household_questions": questions.select(
            "hhid", *[(F.col(name) % 2 + 1).alias(name) for name in answers], "hh_rfact"
        ),
        "v1_member": numbered.select(
            "hhid", F.col("line").alias("lno"), F.coalesce("sex", F.lit(1)).alias("sex"), "age", "rel", "hgc_level",
            F.when(F.col("attend_school").between(1, 4), F.col("attend_school")).alias("attend_school"), "mem_rfact",
        ),
        "v1_literacy": tests.join(
            numbered.select("hhid", F.col("lno").alias("lno_f2"), "line"), ["hhid", "lno_f2"]
        ).select(
            "hhid", F.col("line").alias("lno_f2"), "result_code_f2", F.greatest("age_f2", F.lit(5)).alias("age_f2"),
            "reading", "reading59", "writing", "writing59", "compute", "compute59", "compre",
            F.when(F.col("fllevel") < 4, F.col("fllevel")).alias("fllevel"), "bliterate", "fliterate",
            F.when(F.col("result_code_f2") == 1, F.col("resp_rfact_f2")).otherwise(0.0).alias("resp_rfact_f2"),
        ),
    }


NAMES = {
    "v1_household": "volume1_household.csv",
    "v1_household_questions": "volume1_rtf1.csv",
    "v1_member": "volume1_member.csv",
    "v1_literacy": "volume1_rtf2.csv",
}
SHEET = {
    "urbanity": ["1 - Urban", "2 - Rural", "3 - No official classification"],
    "sex": ["1 - Male", "2 - Female"],
    "hgc_level": [f"{n} - Level {n}" for n in range(1, 6)],
    "result_code_f2": [f"0{n} - Result {n}" for n in range(1, 8)],
    "fllevel": ["0 - Illiterate", "1 - Low Literate", "2 - Basic Literate", "3 - Functional Literate"],
}


def write_raw_files(spark, sf_dir, folder):
    """Write all inputs of a run; returns where they are, as arguments of ``SurveyRun``."""
    for table, frame in survey_tables(spark, sf_dir).items():
        upper = frame.toDF(*[name.upper() for name in frame.columns])
        upper.write.option("header", True).csv(f"{folder}/files/{NAMES[table]}")
    _write_sheet(spark, f"{folder}/sheet")
    _write_regions(spark, sf_dir, f"{folder}/regions")
    return {"raw": f"{folder}/files", "regions": f"{folder}/regions", "sheets": {"survey": f"{folder}/sheet"},
            "min_regions": 1}


def _write_sheet(spark, path):
    rows = []
    for variable, labels in SHEET.items():
        rows.append((f"{variable.upper()}_VS1", variable, None, None, None))
        rows += [(None, None, label, str(int(label.split(" - ")[0])), None) for label in labels]
    sheet = spark.createDataFrame(rows, "c0 string, c1 string, c2 string, c3 string, c4 string")
    sheet.coalesce(1).write.option("header", True).csv(path)


def _write_regions(spark, sf_dir, path):
    regions = roles.dim_region(spark, sf_dir).select(
        F.col("region_code").cast("string").alias("code"), F.col("region_short_name").alias("name"),
        F.col("region_name").alias("regionName"), F.lit("luzon").alias("islandGroupCode"),
        F.rpad(F.lpad(F.col("region_code").cast("string"), 2, "0"), 10, "0").alias("psgc10DigitCode"),
    )
    regions.agg(F.to_json(F.collect_list(F.struct(*regions.columns)))).write.text(path)
