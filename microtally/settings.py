"""Business rules whose values define the results.

Bands, tiers, code meanings, thresholds and orders are part of the data model, so
they are stated here as plain values and nowhere else.
"""

SURVEY_YEAR = 2024

# Lower bound (inclusive) and label of each age band. A band ends where
# the next begins; the last one ends at AGE_TOP (exclusive).
AGE_BANDS = [
    (0, "0-9"),
    (10, "10-14"),
    (15, "15-24"),
    (25, "25-34"),
    (35, "35-44"),
    (45, "45-54"),
    (55, "55-64"),
    (65, "65+"),
]
AGE_TOP = 200

# Fixed value: the age code that means "unknown".
AGE_UNKNOWN = 99

# Age bands eligible for the literacy rates (10 to 64 years).
ELIGIBLE_AGE_BANDS = ["10-14", "15-24", "25-34", "35-44", "45-54", "55-64"]

# Digital access score to tier, and the tiers from low to high.
ACCESS_TIERS = {
    0: "No access",
    1: "Low",
    2: "Low",
    3: "Moderate",
    4: "High",
    5: "High",
}
TIER_ORDER = ["No access", "Low", "Moderate", "High"]

# What the attendance codes mean (public, private, home school; none).
ATTENDING_CODES = [1, 2, 3]
NOT_ATTENDING_CODES = [4]

# Fixed value: two-sided 95% quantile of the normal distribution.
Z_95 = 1.96

# Fixed value: largest share of removed duplicates a staged file may have.
MAX_DUPLICATE_SHARE = 0.01

# Fields every record of the region list must carry, and its least size.
REGION_FIELDS = ["code", "name", "regionName", "islandGroupCode", "psgc10DigitCode"]
MIN_REGIONS = 17

# Source files of the survey, the pattern their names match and their keys.
SURVEY_FILES = {
    "v1_household": {"file_pattern": "*volume1*household*.csv", "key": ["hhid"]},
    "v1_household_questions": {"file_pattern": "*volume1*rtf1*.csv", "key": ["hhid"]},
    "v1_member": {"file_pattern": "*volume1*member*.csv", "key": ["hhid", "lno"]},
    "v1_literacy": {"file_pattern": "*volume1*rtf2*.csv", "key": ["hhid", "lno_f2"]},
}

# Load plan of the warehouse tables, parents before children.
LOAD_PLAN = [
    {"table": "dim_region", "strategy": "upsert", "key": ["region_code"]},
    {"table": "household", "strategy": "replace_year"},
    {"table": "member", "strategy": "replace_year"},
    {"table": "literacy_assessment", "strategy": "replace_year"},
    {"table": "agg_literacy_digital", "strategy": "replace_year"},
]

# Lineage columns of a staged table.
LINEAGE = ["source_file", "source_line", "batch_id", "ingested_at"]

# Fixed value: column the person table is partitioned by.
PARTITION_COLUMN = "region_code"

# Fixed value: region read alone in the partition pruning report.
DEMO_REGION = 13

WEIGHT_TYPE = "decimal(14,8)"
