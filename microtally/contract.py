"""The data contract: what every layer must look like before the next one starts.

A contract has ``raw_files`` and ``tables``. Rules of a raw file: ``min_rows``,
``required_columns``, ``key_columns`` and ``weight`` (``column``, ``positive_when``;
without a condition the weight is positive on every row, with one it is positive exactly
on the matching rows and zero elsewhere). Rules of a table: ``primary_key``,
``min_rows``, ``lineage_columns``, ``foreign_keys`` and per column ``type``,
``nullable``, ``required``, ``accepted_values``, ``min``, ``max``, ``severity``.
:func:`load_contract` reads the same vocabulary from a YAML file.
"""

from pathlib import Path

import yaml

from microtally.settings import AGE_BANDS, LINEAGE, SURVEY_YEAR, TIER_ORDER

TABLE_RULES = {"layer", "description", "primary_key", "min_rows", "lineage_columns", "columns", "foreign_keys"}
COLUMN_RULES = {"type", "nullable", "required", "accepted_values", "min", "max", "severity"}
TYPES = {"integer", "float", "string", "boolean"}


def integer(**rules):
    return {"type": "integer", "nullable": False, **rules}


def positive_weight():
    return {"type": "float", "nullable": False, "min": 0.000001}


def text(**rules):
    return {"type": "string", "nullable": False, **rules}


def optional(kind, **rules):
    return {"type": kind, **rules}


def references(columns, table, parent_columns=None):
    return {"columns": columns, "references": {"table": table, "columns": parent_columns or columns}}


# Region codes of the survey; the second list has the region created later.
REGION_CODES = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19]
REGION_CODES_NEW = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 18, 19]
ISLAND_GROUPS = ["Luzon", "Visayas", "Mindanao"]
URBANITY_LABELS = ["Urban", "Rural", "No official classification"]
LITERACY_LEVELS = ["Illiterate", "Low Literate", "Basic Literate", "Functional Literate"]
RESULT_CODES = [1, 2, 3, 4, 5, 6, 7, 8, 9]

# The questions answered yes (1) or no (2), and the flags derived from them.
YES_NO_QUESTIONS = ["beneficiary_4ps", "electricity", "hh_smartphone", "hh_basicphone", "hh_pc", "hh_tablet",
                    "hh_cabnet", "hh_nocabnet", "hh_mobsub", "ict_equip"]
HOUSEHOLD_FLAGS = ["is_4ps_beneficiary", "has_electricity", "owns_smartphone", "owns_basic_phone", "owns_computer",
                   "owns_tablet", "has_internet_cable", "has_internet_no_cable", "has_home_internet",
                   "has_mobile_subscription", "used_ict_for_learning"]
LITERACY_FLAGS = ["can_read", "can_write", "can_compute", "can_comprehend"]

# Least number of rows of a household file and of a person file.
MIN_HOUSEHOLDS = 100_000
MIN_PERSONS = 300_000

# Rules of the raw files, column names as in their headers.
RAW_FILES = {
    "v1_household": {
        "min_rows": MIN_HOUSEHOLDS,
        "required_columns": ["HHID", "REG", "REG2", "PRV", "URBANITY", "PSU", "INTVW", "RFACT"],
        "key_columns": ["HHID"],
        "weight": {"column": "RFACT"},
    },
    "v1_household_questions": {
        "min_rows": MIN_HOUSEHOLDS,
        "required_columns": ["HHID", *(name.upper() for name in YES_NO_QUESTIONS), "HH_RFACT"],
        "key_columns": ["HHID"],
        "weight": {"column": "HH_RFACT"},
    },
    "v1_member": {
        "min_rows": MIN_PERSONS,
        "required_columns": ["HHID", "LNO", "SEX", "AGE", "HGC_LEVEL", "ATTEND_SCHOOL", "MEM_RFACT"],
        "key_columns": ["HHID", "LNO"],
        "weight": {"column": "MEM_RFACT"},
    },
    "v1_literacy": {
        "min_rows": MIN_PERSONS,
        "required_columns": ["HHID", "LNO_F2", "RESULT_CODE_F2", "AGE_F2", "BLITERATE", "FLITERATE", "FLLEVEL",
                             "RESP_RFACT_F2"],
        "key_columns": ["HHID", "LNO_F2"],
        "weight": {"column": "RESP_RFACT_F2", "positive_when": {"RESULT_CODE_F2": 1}},
    },
}

# Rules of the staging tables, one per source file.
STAGING_TABLES = {
    "v1_household": {
        "primary_key": ["hhid"],
        "min_rows": MIN_HOUSEHOLDS,
        "columns": {
            "hhid": integer(),
            "reg": integer(accepted_values=REGION_CODES),
            "reg2": integer(accepted_values=REGION_CODES_NEW),
            "prv": integer(),
            "urbanity": integer(accepted_values=[1, 2, 3]),
            "psu": integer(),
            "intvw": integer(accepted_values=[1], severity="warning"),
            "rfact": positive_weight(),
        },
    },
    "v1_household_questions": {
        "primary_key": ["hhid"],
        "min_rows": MIN_HOUSEHOLDS,
        "columns": {
            "hhid": integer(),
            **{name: integer(accepted_values=[1, 2]) for name in YES_NO_QUESTIONS},
            "hh_rfact": positive_weight(),
        },
        "foreign_keys": [references(["hhid"], "v1_household")],
    },
    "v1_member": {
        "primary_key": ["hhid", "lno"],
        "min_rows": MIN_PERSONS,
        "columns": {
            "hhid": integer(),
            "lno": integer(min=1, max=99),
            "sex": integer(accepted_values=[1, 2]),
            "age": integer(min=0, max=99),
            "hgc_level": optional("integer", accepted_values=[0, 1, 2, 3, 4, 5, 6, 7, 8]),
            "attend_school": optional("integer", accepted_values=[1, 2, 3, 4]),
            "mem_rfact": positive_weight(),
        },
        "foreign_keys": [references(["hhid"], "v1_household")],
    },
    "v1_literacy": {
        "primary_key": ["hhid", "lno_f2"],
        "min_rows": MIN_PERSONS,
        "columns": {
            "hhid": integer(),
            "lno_f2": integer(min=1, max=99),
            "result_code_f2": integer(accepted_values=RESULT_CODES),
            "age_f2": integer(min=5, max=99),
            "bliterate": optional("integer", accepted_values=[1, 2]),
            "fliterate": optional("integer", accepted_values=[1, 2]),
            "fllevel": optional("integer", accepted_values=[0, 1, 2, 3]),
            "resp_rfact_f2": {"type": "float", "nullable": False, "min": 0},
        },
        "foreign_keys": [references(["hhid", "lno_f2"], "v1_member", ["hhid", "lno"])],
    },
}
for _spec in STAGING_TABLES.values():
    _spec.update(layer="staging", lineage_columns=LINEAGE)

# Rules of the curated tables.
CURATED_TABLES = {
    "dim_region": {
        "primary_key": ["region_code"],
        "min_rows": 17,
        "columns": {
            "region_code": integer(min=1, max=19),
            "region_name": text(),
            "region_short_name": text(),
            "island_group": text(accepted_values=ISLAND_GROUPS),
            "psgc_code": text(),
        },
    },
    "household": {
        "primary_key": ["survey_year", "hhid"],
        "min_rows": MIN_HOUSEHOLDS,
        "lineage_columns": ["batch_id"],
        "columns": {
            "survey_year": integer(accepted_values=[SURVEY_YEAR]),
            "hhid": integer(),
            "region_code": integer(),
            "region_code_nir": integer(),
            "province_code": integer(),
            "psu": integer(),
            "urbanity": text(accepted_values=URBANITY_LABELS),
            **{name: {"type": "boolean", "nullable": False} for name in HOUSEHOLD_FLAGS},
            "digital_access_score": integer(min=0, max=5),
            "digital_access_tier": text(accepted_values=TIER_ORDER),
            "household_weight": positive_weight(),
            "batch_id": text(),
        },
        "foreign_keys": [references(["region_code"], "dim_region")],
    },
    "member": {
        "primary_key": ["survey_year", "hhid", "line_no"],
        "min_rows": MIN_PERSONS,
        "lineage_columns": ["batch_id"],
        "columns": {
            "survey_year": integer(accepted_values=[SURVEY_YEAR]),
            "hhid": integer(),
            "line_no": integer(min=1),
            "sex": text(accepted_values=["Male", "Female"]),
            "age": optional("integer", min=0, max=98),
            "age_group": optional("string", accepted_values=[label for _, label in AGE_BANDS]),
            "education_level_code": optional("integer", min=0, max=8),
            "education_level": optional("string"),
            "attending_school": optional("boolean"),
            "member_weight": positive_weight(),
            "batch_id": text(),
        },
        "foreign_keys": [references(["survey_year", "hhid"], "household")],
    },
    "literacy_assessment": {
        "primary_key": ["survey_year", "hhid", "line_no"],
        "min_rows": MIN_PERSONS,
        "lineage_columns": ["batch_id"],
        "columns": {
            "survey_year": integer(accepted_values=[SURVEY_YEAR]),
            "hhid": integer(),
            "line_no": integer(min=1),
            "result_code": integer(accepted_values=RESULT_CODES),
            "result": text(),
            "interview_completed": {"type": "boolean", "nullable": False},
            **{name: optional("boolean") for name in LITERACY_FLAGS},
            "functional_literacy_level_code": optional("integer", min=0, max=3),
            "functional_literacy_level": optional("string", accepted_values=LITERACY_LEVELS),
            "basic_literate": optional("boolean"),
            "functional_literate": optional("boolean"),
            "respondent_weight": {"type": "float", "nullable": False, "min": 0},
            "batch_id": text(),
        },
        "foreign_keys": [references(["survey_year", "hhid", "line_no"], "member")],
    },
    "agg_literacy_digital": {
        "primary_key": ["survey_year", "region_code", "age_group", "digital_access_tier"],
        "min_rows": 50,
        "lineage_columns": ["batch_id"],
        "columns": {
            "survey_year": integer(),
            "region_code": integer(),
            "age_group": text(),
            "digital_access_tier": text(accepted_values=TIER_ORDER),
            "persons_sampled": integer(min=1),
            "weighted_population": {"type": "float", "nullable": False, "min": 0},
            "functional_literacy_rate": optional("float", min=0, max=100),
            "basic_literacy_rate": optional("float", min=0, max=100),
            "batch_id": text(),
        },
        "foreign_keys": [references(["region_code"], "dim_region")],
    },
    "person_profile": {
        "primary_key": ["hhid", "line_no"],
        "min_rows": MIN_PERSONS,
        "columns": {
            "survey_year": integer(),
            "region_code": integer(),
            "region_name": text(),
            "hhid": integer(),
            "line_no": integer(),
            "digital_access_tier": text(),
        },
        "foreign_keys": [references(["survey_year", "hhid", "line_no"], "member")],
    },
}
for _spec in CURATED_TABLES.values():
    _spec.update(layer="curated")

SURVEY_CONTRACT = {"raw_files": RAW_FILES, "tables": {**STAGING_TABLES, **CURATED_TABLES}}


def load_contract(path) -> dict:
    """Read a YAML contract and check that it only uses known rules."""
    contract = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    for name, spec in contract.get("tables", {}).items():
        check_spec(name, spec)
    return contract


def check_spec(name: str, spec: dict) -> dict:
    """Reject misspelt rules: a rule nobody enforces is worse than an error."""
    unknown = set(spec) - TABLE_RULES
    for column, rules in spec["columns"].items():
        unknown |= {f"{column}.{rule}" for rule in set(rules) - COLUMN_RULES}
        if rules["type"] not in TYPES:
            unknown.add(f"{column}.type={rules['type']}")
    if unknown:
        raise ValueError(f"contract of {name}: unknown rules {sorted(unknown)}")
    return spec


def without_minimums(contract: dict) -> dict:
    """The same rules for inputs of any size: every table needs only one row."""
    return {
        section: {name: {**spec, "min_rows": 1} for name, spec in contract[section].items()}
        for section in ("raw_files", "tables")
    }
