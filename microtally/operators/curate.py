"""Staging to curated: region list, household, member, assessment, person profile, aggregate.

Every builder is one lazy projection or join; the rules they apply are fixed values in
``settings``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from microtally.functions.coded import any_flag, band, code_flag, complete_sum, lookup, sentinel_to_null, yes_no
from microtally.functions.weighted import weighted_rate, weighted_total
from microtally.operators.joins import join_many_to_one, join_one_to_one, unique_by
from microtally.settings import (
    ACCESS_TIERS,
    AGE_BANDS,
    AGE_TOP,
    AGE_UNKNOWN,
    ATTENDING_CODES,
    LINEAGE,
    NOT_ATTENDING_CODES,
    WEIGHT_TYPE,
)
from microtally.sources.codebook import decode

# Columns the household record already has; the questions file repeats them.
REPEATED = ["reg", "reg2", "prv", "urbanity", *LINEAGE, "hh_rfact"]

SCORE_PARTS = ["owns_smartphone", "owns_computer", "owns_tablet", "has_home_internet", "has_mobile_subscription"]

PROFILE_HOUSEHOLD = [
    "survey_year", "hhid", "region_code", "urbanity", "has_electricity", "owns_smartphone", "owns_computer",
    "owns_tablet", "has_home_internet", "has_mobile_subscription", "used_ict_for_learning",
    "digital_access_score", "digital_access_tier", "household_weight",
]
PROFILE_ASSESSMENT = [
    "survey_year", "hhid", "line_no", "interview_completed", "basic_literate", "functional_literate",
    "functional_literacy_level", "respondent_weight",
]


def build_dim_region(regions: DataFrame) -> DataFrame:
    """Official names by region code, the first two digits of the 10-digit code."""
    numbered = F.col("regionName").startswith("Region ")
    return regions.select(
        F.substring("psgc10DigitCode", 1, 2).cast("long").alias("region_code"),
        F.when(numbered, F.concat_ws(" - ", "regionName", "name")).otherwise(F.col("regionName")).alias("region_name"),
        F.col("name").alias("region_short_name"),
        F.initcap("islandGroupCode").alias("island_group"),
        F.col("psgc10DigitCode").alias("psgc_code"),
    )


def access_score() -> "F.Column":
    return complete_sum(*[F.col(name) for name in SCORE_PARTS])


def derive_household(joined: DataFrame, year: int, batch_id: str) -> DataFrame:
    """Business columns of a household from its joined records; ``urbanity_label`` is decoded."""
    named = joined.select(
        F.lit(year).alias("survey_year"),
        "hhid",
        F.col("reg").alias("region_code"),
        F.col("reg2").alias("region_code_nir"),
        F.col("prv").alias("province_code"),
        "psu",
        F.col("urbanity_label").alias("urbanity"),
        yes_no(F.col("beneficiary_4ps")).alias("is_4ps_beneficiary"),
        yes_no(F.col("electricity")).alias("has_electricity"),
        yes_no(F.col("hh_smartphone")).alias("owns_smartphone"),
        yes_no(F.col("hh_basicphone")).alias("owns_basic_phone"),
        yes_no(F.col("hh_pc")).alias("owns_computer"),
        yes_no(F.col("hh_tablet")).alias("owns_tablet"),
        yes_no(F.col("hh_cabnet")).alias("has_internet_cable"),
        yes_no(F.col("hh_nocabnet")).alias("has_internet_no_cable"),
        any_flag(yes_no(F.col("hh_cabnet")), yes_no(F.col("hh_nocabnet"))).alias("has_home_internet"),
        yes_no(F.col("hh_mobsub")).alias("has_mobile_subscription"),
        yes_no(F.col("ict_equip")).alias("used_ict_for_learning"),
        F.col("rfact").cast(WEIGHT_TYPE).alias("_weight"),
    )
    return (
        named.withColumn("digital_access_score", access_score())
        .withColumn("digital_access_tier", lookup(F.col("digital_access_score"), ACCESS_TIERS))
        .withColumn("household_weight", F.col("_weight"))
        .withColumn("batch_id", F.lit(batch_id))
        .drop("_weight")
    )


def build_household(records: DataFrame, questions: DataFrame, codebook: DataFrame, year: int,
                    batch_id: str) -> DataFrame:
    """One row per household; fails if the two files do not match one to one."""
    extra = questions.drop(*REPEATED)
    joined = join_one_to_one(records, extra, ["hhid"])
    return derive_household(decode(joined, codebook, {"urbanity_label": ("urbanity", "urbanity")}), year, batch_id)


def build_member(members: DataFrame, codebook: DataFrame, year: int, batch_id: str) -> DataFrame:
    """One row per person."""
    decoded = decode(members, codebook, {
        "sex_label": ("sex", "sex"),
        "education_label": ("hgc_level", "hgc_level"),
    })
    age = sentinel_to_null(F.col("age"), AGE_UNKNOWN)
    return decoded.select(
        F.lit(year).alias("survey_year"),
        "hhid",
        F.col("lno").alias("line_no"),
        F.col("sex_label").alias("sex"),
        age.cast("long").alias("age"),
        band(age, AGE_BANDS, AGE_TOP).alias("age_group"),
        F.col("rel").alias("relationship_code"),
        F.col("hgc_level").alias("education_level_code"),
        F.col("education_label").alias("education_level"),
        code_flag(F.col("attend_school"), ATTENDING_CODES, NOT_ATTENDING_CODES).alias("attending_school"),
        F.col("mem_rfact").cast(WEIGHT_TYPE).alias("member_weight"),
        F.lit(batch_id).alias("batch_id"),
    )


def build_assessment(assessed: DataFrame, codebook: DataFrame, year: int, batch_id: str) -> DataFrame:
    """One row per tested person; ages 5 to 9 have their own variants of three questions."""
    decoded = decode(assessed, codebook, {
        "result_label": ("result_code_f2", "result_code_f2"),
        "level_label": ("fllevel", "fllevel"),
    })
    return decoded.select(
        F.lit(year).alias("survey_year"),
        "hhid",
        F.col("lno_f2").alias("line_no"),
        F.col("result_code_f2").alias("result_code"),
        F.col("result_label").alias("result"),
        (F.col("result_code_f2") == 1).alias("interview_completed"),
        yes_no(F.coalesce("reading", "reading59")).alias("can_read"),
        yes_no(F.coalesce("writing", "writing59")).alias("can_write"),
        yes_no(F.coalesce("compute", "compute59")).alias("can_compute"),
        yes_no(F.col("compre")).alias("can_comprehend"),
        F.col("fllevel").alias("functional_literacy_level_code"),
        F.col("level_label").alias("functional_literacy_level"),
        yes_no(F.col("bliterate")).alias("basic_literate"),
        yes_no(F.col("fliterate")).alias("functional_literate"),
        F.col("resp_rfact_f2").cast(WEIGHT_TYPE).alias("respondent_weight"),
        F.lit(batch_id).alias("batch_id"),
    )


def build_person_profile(household: DataFrame, member: DataFrame, assessment: DataFrame,
                         regions: DataFrame) -> DataFrame:
    """One row per member with everything joined; a member without a match keeps nulls.

    Members and assessments match one to one: a repeated key on either side fails the job.

    Both big joins start with (survey_year, hhid). With the session settings of this
    package the member rows are hashed on it once and stay in place for the second join.
    """
    person = ["survey_year", "hhid", "line_no"]
    people = unique_by(member.drop("batch_id"), person, "member")
    with_home = join_many_to_one(people, household.select(*PROFILE_HOUSEHOLD), ["survey_year", "hhid"])
    with_test = join_many_to_one(with_home, assessment.select(*PROFILE_ASSESSMENT), person)
    named = join_many_to_one(with_test, regions.select("region_code", "region_name"), ["region_code"])
    columns = [*people.columns, *PROFILE_HOUSEHOLD[2:], *PROFILE_ASSESSMENT[3:], "region_name"]
    return named.select(*columns)


def build_aggregate(profile: DataFrame, year: int, batch_id: str) -> DataFrame:
    """Weighted literacy rates by region, age band and access tier of assessed persons.

    Groups with a missing key are left out.
    """
    keys = ["region_code", "age_group", "digital_access_tier"]
    weight = F.col("respondent_weight")
    assessed = profile.where(F.col("functional_literate").isNotNull()).dropna(subset=keys)
    return assessed.groupBy(*keys).agg(
        F.count("*").alias("persons_sampled"),
        F.round(weighted_total(weight), 2).cast("decimal(16,2)").alias("weighted_population"),
        weighted_rate(F.col("functional_literate"), weight).alias("functional_literacy_rate"),
        weighted_rate(F.col("basic_literate"), weight).alias("basic_literacy_rate"),
    ).select(
        F.lit(year).alias("survey_year"), *keys, "persons_sampled", "weighted_population",
        "functional_literacy_rate", "basic_literacy_rate", F.lit(batch_id).alias("batch_id"),
    )
