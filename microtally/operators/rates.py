"""Weighted rates of the curated tables: the analytical queries as DataFrames.

Assessments outnumber households, and one household may hold many of them, so they are
added up per household before they meet it. The sums are decimals, hence the result is the
same as joining first.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from microtally.errors import JoinContractError
from microtally.functions.weighted import ratio_pct, weighted_share, weighted_total
from microtally.settings import ELIGIBLE_AGE_BANDS, TIER_ORDER

HOUSEHOLD_KEY = ["survey_year", "hhid"]
PERSON_KEY = ["survey_year", "hhid", "line_no"]


def eligible(assessment: DataFrame) -> DataFrame:
    """Persons with a functional literacy outcome (10 to 64 years)."""
    return assessment.where(F.col("functional_literate").isNotNull())


def load_check(tables: dict) -> DataFrame:
    """Row counts of the loaded tables in one row; each is read from file footers."""
    counted = {
        "households": "household",
        "members": "member",
        "literacy_records": "literacy_assessment",
        "aggregate_rows": "agg_literacy_digital",
    }
    missing = sorted(set(counted.values()) - set(tables))
    if missing:
        raise JoinContractError(f"tables to count are missing: {missing}")
    counts = [
        tables[table].agg(F.count("*").alias("n")).select(F.lit(out).alias("counter"), "n")
        for out, table in counted.items()
    ]
    stacked = counts[0]
    for count in counts[1:]:
        stacked = stacked.unionByName(count)
    return stacked.groupBy().pivot("counter", list(counted)).agg(F.max("n"))


def rate_overall(assessment: DataFrame) -> DataFrame:
    """Population in millions and the two national rates, each over its own base."""
    weight = F.col("respondent_weight")
    functional, basic = F.col("functional_literate"), F.col("basic_literate")
    millions = lambda total: F.round(total.cast("double") / 1e6, 2)
    return eligible(assessment).agg(
        millions(weighted_total(weight)).alias("population_10_64_millions"),
        millions(weighted_total(weight, functional)).alias("functionally_literate_millions"),
        weighted_share(functional, weight).alias("functional_literacy_rate_pct"),
        weighted_share(basic, weight, basic.isNotNull()).alias("basic_literacy_rate_pct"),
    )


def assessed_per_household(assessment: DataFrame) -> DataFrame:
    """Persons, weight and literate weight of each household with eligible persons."""
    weight = F.col("respondent_weight")
    return eligible(assessment).groupBy(*HOUSEHOLD_KEY).agg(
        F.count("*").alias("persons"),
        weighted_total(weight).alias("weight"),
        weighted_total(weight, F.col("functional_literate")).alias("literate_weight"),
    )


def literacy_by(assessment: DataFrame, household: DataFrame, columns, *extra) -> DataFrame:
    """Persons and functional literacy rate by household columns.

    ``extra`` are further aggregates; they may use ``weight`` and the household columns.
    """
    needed = [*HOUSEHOLD_KEY, *columns, "digital_access_score", "has_home_internet"]
    joined = assessed_per_household(assessment).join(
        household.select(*dict.fromkeys(needed)), HOUSEHOLD_KEY
    )
    return joined.groupBy(*columns).agg(
        F.sum("persons").alias("persons_sampled"),
        ratio_pct(F.sum("literate_weight"), F.sum("weight"), 1).alias("functional_literacy_rate_pct"),
        *extra,
    )


def rate_by_tier(assessment: DataFrame, household: DataFrame) -> DataFrame:
    """Functional literacy by access tier, from the lowest access score up."""
    lowest = F.min("digital_access_score").alias("_lowest")
    rates = literacy_by(assessment, household, ["digital_access_tier"], lowest)
    return rates.orderBy(F.asc_nulls_last("_lowest")).select(
        "digital_access_tier", "persons_sampled", "functional_literacy_rate_pct"
    )


def rate_by_urbanity(assessment: DataFrame, household: DataFrame) -> DataFrame:
    """Home internet and functional literacy of persons by urbanity."""
    connected = F.sum(F.when(F.col("has_home_internet"), F.col("weight")))
    online = ratio_pct(connected, F.sum("weight"), 1).alias("living_with_home_internet_pct")
    return literacy_by(assessment, household, ["urbanity"], online).select(
        "urbanity", F.col("persons_sampled").alias("n_persons"), "living_with_home_internet_pct",
        "functional_literacy_rate_pct",
    )


def internet_by(household: DataFrame, column: str) -> DataFrame:
    """Households and their home internet share."""
    share = weighted_share(F.col("has_home_internet"), F.col("household_weight"))
    return household.groupBy(column).agg(
        F.count("*").alias("n_households"), share.alias("households_with_home_internet_pct")
    )


def divide_by_region(assessment: DataFrame, household: DataFrame, regions: DataFrame) -> DataFrame:
    """Home internet access beside functional literacy, the best connected region first."""
    literacy = literacy_by(assessment, household, ["region_code"])
    return (
        regions.select("region_code", "region_name")
        .join(internet_by(household, "region_code"), "region_code")
        .join(literacy, "region_code")
        .orderBy(F.desc_nulls_first("households_with_home_internet_pct"), "region_name")
        .select(
            "region_name", "n_households", "households_with_home_internet_pct",
            F.col("persons_sampled").alias("n_persons"), "functional_literacy_rate_pct",
        )
    )


def assessed_persons(assessment: DataFrame, member: DataFrame, household: DataFrame, member_columns,
                     household_columns) -> DataFrame:
    """Eligible persons with columns of their member record and of their household."""
    people = eligible(assessment).select(*PERSON_KEY, "functional_literate", "respondent_weight")
    homes = household.select(*HOUSEHOLD_KEY, *household_columns)
    return people.join(homes, HOUSEHOLD_KEY).join(member.select(*PERSON_KEY, *member_columns), PERSON_KEY)


def rate_by_band(assessment: DataFrame, member: DataFrame, household: DataFrame) -> DataFrame:
    """Home internet and functional literacy of persons by age band."""
    weight = F.col("respondent_weight")
    people = assessed_persons(assessment, member, household, ["age_group"], ["has_home_internet"])
    return people.groupBy("age_group").agg(
        weighted_share(F.col("has_home_internet"), weight).alias("living_with_home_internet_pct"),
        weighted_share(F.col("functional_literate"), weight).alias("functional_literacy_rate_pct"),
    ).orderBy(F.asc_nulls_last("age_group"))


def rate_by_education(assessment: DataFrame, member: DataFrame, household: DataFrame) -> DataFrame:
    """Better access and functional literacy by education level, unknown level first."""
    weight = F.col("respondent_weight")
    level = ["education_level_code", "education_level"]
    people = assessed_persons(assessment, member, household, level, ["digital_access_tier"])
    better = F.col("digital_access_tier").isin(TIER_ORDER[2:])
    return (
        people.groupBy(*level)
        .agg(
            F.count("*").alias("persons_sampled"),
            weighted_share(better, weight).alias("moderate_or_high_access_pct"),
            weighted_share(F.col("functional_literate"), weight).alias("functional_literacy_rate_pct"),
        )
        .orderBy(F.asc_nulls_first("education_level_code"))
        .drop("education_level_code")
    )


def top_bottom_regions(household: DataFrame, regions: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` best and the ``k`` least connected regions in one result."""
    weighted = household.groupBy("region_code").agg(
        weighted_total(F.col("household_weight")).alias("weight"),
        weighted_total(F.col("household_weight"), F.col("has_home_internet")).alias("connected"),
    )
    share = ratio_pct(F.sum("connected"), F.sum("weight"), 1).alias("households_with_internet_pct")
    shares = (
        weighted.join(regions.select("region_code", F.col("region_short_name").alias("region")), "region_code")
        .groupBy("region")
        .agg(share)
    )
    best = shares.orderBy(F.desc_nulls_first("households_with_internet_pct"), "region").limit(k)
    least = shares.orderBy(F.asc_nulls_last("households_with_internet_pct"), "region").limit(k)
    return best.unionByName(least)


def trace_record(profile: DataFrame, hhid, line_no) -> DataFrame:
    """One person across all joined tables; both keys reach the Parquet filters."""
    return profile.where((F.col("hhid") == hhid) & (F.col("line_no") == line_no))


def region_dashboard(aggregate: DataFrame, region_code) -> DataFrame:
    """The ready-made aggregate of one region by age band and tier."""
    return (
        aggregate.where(F.col("region_code") == region_code)
        .select("age_group", "digital_access_tier", "persons_sampled", "functional_literacy_rate")
        .orderBy("age_group", "digital_access_tier")
    )


def sample_sizes(aggregate: DataFrame, regions: DataFrame) -> DataFrame:
    """Unweighted persons by region and tier (eligible ages), with the smallest cell of a region."""
    cells = (
        aggregate.where(F.col("age_group").isin(ELIGIBLE_AGE_BANDS))
        .groupBy("region_code")
        .pivot("digital_access_tier", TIER_ORDER)
        .agg(F.sum("persons_sampled"))
    )
    names = regions.select("region_code", F.col("region_short_name").alias("_name"))
    label = F.coalesce("_name", F.concat(F.lit("Region "), F.col("region_code").cast("string")))
    return (
        cells.join(names, "region_code", "left")
        .select(
            label.alias("region"), *TIER_ORDER, F.least(*[F.col(f"`{tier}`") for tier in TIER_ORDER]).alias("smallest_cell")
        )
        .orderBy("region")
    )


VIEW_COLUMNS = [
    "survey_year", "region_code", "region_name", "urbanity", "hhid", "line_no", "sex", "age", "age_group",
    "education_level", "has_home_internet", "owns_smartphone", "owns_computer", "digital_access_score",
    "digital_access_tier", "interview_completed", "basic_literate", "functional_literate",
    "functional_literacy_level", "respondent_weight",
]


def profile_view(member: DataFrame, household: DataFrame, regions: DataFrame, assessment: DataFrame) -> DataFrame:
    """Persons whose household and region are known, with their assessment if there is one."""
    homes = household.drop("batch_id").join(regions.select("region_code", "region_name"), "region_code")
    people = member.drop("batch_id").join(homes, HOUSEHOLD_KEY)
    return people.join(assessment.drop("batch_id"), PERSON_KEY, "left").select(*VIEW_COLUMNS)


def register_views(tables: dict) -> None:
    """Curated tables and the person view under their names, ready for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    view = profile_view(
        tables["member"], tables["household"], tables["dim_region"], tables["literacy_assessment"]
    )
    view.createOrReplaceTempView("v_person_profile")
