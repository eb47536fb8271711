"""Design-based estimates: weighted shares with Taylor-linearised standard errors.

Strata are sampled independently, clusters within a stratum. For a share ``p`` with weight
total ``W`` the linearised total of a cluster is ``z = ((1 - p) * a - p * c) / W``, with
``a`` the weight of its positives and ``c`` the weight of the rest. The variance of a
stratum with ``k`` clusters is ``k / (k - 1)`` times the sum of squared deviations of
``z``. As ``z`` is linear in ``a`` and ``c``, that sum follows from the scatter of ``a``
and ``c`` over the clusters, which one aggregation per stratum yields. Clusters without
anybody in a domain count as zeros; their share of the scatter is added by formula, so no
domain-by-cluster grid is ever built.

Only the first aggregation, to clusters, moves data in proportion to the input, and it is
reduced before its shuffle.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microtally.functions.coded import lookup
from microtally.session import checkpointed
from microtally.settings import TIER_ORDER, Z_95

# Names of the indicators and breakdowns in the published table.
FUNCTIONAL = "Functional literacy (persons 10-64)"
BASIC = "Basic literacy (persons 10-64)"
INTERNET = "Households with home internet"

# Blocks of the published table in their order.
BLOCKS = [
    (FUNCTIONAL, "National"),
    (BASIC, "National"),
    (FUNCTIONAL, "Digital access tier"),
    (FUNCTIONAL, "Region"),
    (INTERNET, "National"),
    (INTERNET, "Region"),
]
PERCENTAGES = ["weighted_pct", "se_pct", "ci95_low", "ci95_high"]


def outcome_totals(y: str, w: str, prefix: str = "") -> list[Column]:
    """Aggregates of an outcome: weight of positives, weight of the rest, rows.

    Rows without an outcome or weight do not take part.
    """
    value, weight = f"CAST(`{y}` AS double)", f"CAST(`{w}` AS double)"
    return [
        F.expr(f"sum({value} * {weight}) AS {prefix}a"),
        F.expr(f"sum((1 - {value}) * {weight}) AS {prefix}c"),
        F.expr(f"count_if({value} * {weight} IS NOT NULL) AS {prefix}n"),
    ]


def merge_totals(*prefixes: str) -> list[Column]:
    """Add up partial outcome totals."""
    return [F.expr(f"sum({p}{name}) AS {p}{name}") for p in prefixes or ("",) for name in ("a", "c", "n")]


def weighted_proportion(df: DataFrame, y: str, w: str, strata: str, cluster, by: str | None = None) -> DataFrame:
    """Weighted share of ``y`` (0/1 or boolean) overall or per domain of ``by``.

    ``cluster`` is one column or a list of them. Columns: ``group, unweighted_n,
    weighted_pct, se_pct, ci95_low, ci95_high, design_effect``.
    """
    clusters = [cluster] if isinstance(cluster, str) else list(cluster)
    keys = list(dict.fromkeys([strata, *clusters, *([by] if by else [])]))
    totals = df.groupBy(*keys).agg(*outcome_totals(y, w))
    return linearise(totals, strata, clusters, by)


def linearise(totals: DataFrame, strata: str, clusters, by: str | None = None, per=()) -> DataFrame:
    """Estimates from totals per cluster and domain (``a``, ``c``, ``n``).

    Totals may be finer than needed; they are added up first. A row whose stratum or
    cluster is unknown counts for the share, not for the variance. ``per`` names columns
    that hold several estimates in one frame; they come first in the result.
    """
    per = list(per)
    overall = stratum_moments(totals, strata, clusters, per)
    if by in (None, strata):
        # Every cluster of a stratum with rows in the domain is present in it.
        group = F.lit("All") if by is None else F.col(strata)
        scatter = overall.withColumn("group", group).withColumn("k", F.col("m"))
    else:
        sizes = overall.select(*per, F.col(strata).alias("_stratum"), F.col("m").alias("k"))
        within = stratum_moments(totals.where(F.col(by).isNotNull()), strata, clusters, [*per, by])
        placed = within.withColumn("_stratum", F.col(strata))
        scatter = placed.join(sizes, [*per, "_stratum"], "left").withColumn("group", F.col(by))
    return scatter.where("group IS NOT NULL").groupBy(*per, "group").agg(
        *merge_totals(),
        _scatter("var_a", "mean_a", "mean_a", "s_aa"),
        _scatter("var_c", "mean_c", "mean_c", "s_cc"),
        _scatter("cov", "mean_a", "mean_c", "s_ac"),
    ).selectExpr("*", *SHARES).selectExpr("*", VARIANCE).selectExpr(*per, "group", *FIGURES)


def stratum_moments(totals: DataFrame, strata: str, clusters, domain) -> DataFrame:
    """Totals per stratum and domain, and how they scatter over its ``m`` clusters."""
    keys = [strata, *[name for name in clusters if name != strata]]
    cells = totals.where("n > 0").groupBy(*dict.fromkeys([*keys, *domain])).agg(*merge_totals())
    placed = " AND ".join(f"`{name}` IS NOT NULL" for name in keys)
    a, c = f"CASE WHEN {placed} THEN a END", f"CASE WHEN {placed} THEN c END"
    moments = [f"count({a}) AS m", f"avg({a}) AS mean_a", f"avg({c}) AS mean_c", f"var_pop({a}) AS var_a",
               f"var_pop({c}) AS var_c", f"covar_pop({a}, {c}) AS cov"]
    return cells.groupBy(*domain, strata).agg(*merge_totals(), *[F.expr(moment) for moment in moments])


def _scatter(moment: str, left: str, right: str, name: str) -> Column:
    """Stratum scatter times ``k / (k - 1)``: the present clusters plus the absent zeros.

    A stratum with one cluster adds nothing.
    """
    return F.expr(
        f"""sum(CASE WHEN k > 1 AND m > 0
                THEN (m * {moment} + {left} * {right} * m * (k - m) / k) * k / (k - 1) ELSE 0D END) AS {name}"""
    )


SHARES = ["try_divide(a, a + c) AS p", "try_divide(c, a + c) AS q"]
VARIANCE = (
    "greatest(try_divide(q * q * s_aa - 2 * p * q * s_ac + p * p * s_cc, pow(a + c, 2)), 0D) AS variance"
)
FIGURES = [
    "n AS unweighted_n",
    "100 * p AS weighted_pct",
    "100 * sqrt(variance) AS se_pct",
    f"100 * greatest(p - {Z_95}D * sqrt(variance), 0D) AS ci95_low",
    f"100 * least(p + {Z_95}D * sqrt(variance), 1D) AS ci95_high",
    "CASE WHEN p * (1 - p) > 0 THEN variance / (p * (1 - p) / n) END AS design_effect",
]


def rounded(estimates: DataFrame) -> DataFrame:
    """Published precision: percentages to 3 places, the design effect to 2."""
    places = dict.fromkeys(PERCENTAGES, 3) | {"design_effect": 2}
    return estimates.selectExpr(
        *[f"round({name}, {places[name]}) AS {name}" if name in places else f"`{name}`" for name in estimates.columns]
    )


def person_totals(assessment: DataFrame, household: DataFrame, design, domain: str) -> DataFrame:
    """Cluster totals of both literacy outcomes of the eligible persons, by domain.

    Persons are added up per household first; the household then places them.
    """
    eligible = assessment.where(F.col("functional_literate").isNotNull())
    per_home = eligible.groupBy("survey_year", "hhid").agg(
        *outcome_totals("functional_literate", "respondent_weight", "functional_"),
        *outcome_totals("basic_literate", "respondent_weight", "basic_"),
    )
    homes = household.select("survey_year", "hhid", *design, domain)
    placed = per_home.join(homes, ["survey_year", "hhid"], "left")
    return placed.groupBy(*design, domain).agg(*merge_totals("functional_", "basic_"))


def outcomes_as_rows(totals: DataFrame, prefixes: dict, keys) -> DataFrame:
    """One row per indicator: ``prefixes`` maps an indicator to the prefix of its totals."""
    rows = [
        F.struct(F.lit(indicator).alias("indicator"), *[F.col(f"{prefix}{name}").alias(name) for name in ("a", "c", "n")])
        for indicator, prefix in prefixes.items()
    ]
    return totals.select(*keys, F.inline(F.array(*rows)))


def key_indicators(household: DataFrame, assessment: DataFrame, regions: DataFrame, batch_id: str) -> DataFrame:
    """Headline rates with 95% intervals: six blocks in their published order.

    Persons are scanned, joined and aggregated once, to region, cluster and tier, for both
    outcomes; households once. The cluster totals, all indicators together, are
    checkpointed: every block starts from them, and none goes back to the data.
    """
    strata, design, tier, per = "region_code", ["region_code", "province_code", "psu"], "digital_access_tier", ["indicator"]
    persons = person_totals(assessment, household, design, tier)
    homes = household.groupBy(*design, tier).agg(*outcome_totals("has_home_internet", "household_weight"))
    totals = checkpointed(
        outcomes_as_rows(persons, {FUNCTIONAL: "functional_", BASIC: "basic_"}, [*design, tier])
        .unionByName(outcomes_as_rows(homes, {INTERNET: ""}, [*design, tier]))
    )
    names = regions.select(F.col("region_code").alias("group"), F.col("region_short_name").alias("_name"))

    national = linearise(totals, strata, design, None, per)
    by_tier = complete_tiers(linearise(totals.where(F.col("indicator") == FUNCTIONAL), strata, design, tier, per))
    by_region = linearise(totals.where(F.col("indicator") != BASIC), strata, design, strata, per)
    named = by_region.join(names, "group", "left").withColumn("group", F.col("_name")).drop("_name")
    blocks = {"National": national, "Digital access tier": by_tier, "Region": named}
    labelled = [block.withColumn("breakdown", F.lit(breakdown)) for breakdown, block in blocks.items()]
    stacked = rounded(reduce(DataFrame.unionByName, labelled))

    position = lookup(F.concat_ws("|", "indicator", "breakdown"), {"|".join(b): i for i, b in enumerate(BLOCKS)})
    tier_rank = lookup(F.col("group"), {name: float(i) for i, name in enumerate(TIER_ORDER)})
    rank = F.when(F.col("breakdown") == "Region", -F.col("weighted_pct")).otherwise(tier_rank)
    return stacked.orderBy(position, rank, "group").select(
        "indicator", "breakdown", "group", "unweighted_n", *PERCENTAGES, "design_effect", F.lit(batch_id).alias("batch_id")
    )


def complete_tiers(estimates: DataFrame) -> DataFrame:
    """One row per tier of the fixed list; a tier without persons has empty figures."""
    listed = F.explode(F.array(*[F.lit(name) for name in TIER_ORDER])).alias("group")
    tiers = estimates.sparkSession.range(1).select(F.lit(FUNCTIONAL).alias("indicator"), listed)
    return tiers.join(estimates, ["indicator", "group"], "left")


def tier_table(estimates: DataFrame) -> DataFrame:
    """Literacy by tier with interval and sample size, tiers with persons from low to high."""
    order = lookup(F.col("group"), {name: i for i, name in enumerate(TIER_ORDER)})
    rows = estimates.where(
        (F.col("indicator") == FUNCTIONAL) & (F.col("breakdown") == "Digital access tier")
        & F.col("unweighted_n").isNotNull()
    )
    return rows.orderBy(order).select("group", *FIGURE_COLUMNS)


def region_table(estimates: DataFrame) -> DataFrame:
    """Home internet by region with the national rate beside it, lowest region first."""
    rows = estimates.where(F.col("indicator") == INTERNET)
    national = rows.where(F.col("breakdown") == "National").select(
        "indicator", F.col("weighted_pct").alias("national_pct")
    )
    regions = rows.where(F.col("breakdown") == "Region")
    return (
        regions.join(national, "indicator")
        .orderBy(F.asc_nulls_last("weighted_pct"), "group")
        .select("group", *FIGURE_COLUMNS, "national_pct")
    )


FIGURE_COLUMNS = ["unweighted_n", "weighted_pct", "ci95_low", "ci95_high"]
