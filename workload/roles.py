"""Survey roles of the test tables.

A customer is a household, an order a person of it, all line items of an order together that
person's assessment, a nation a province and a region a region. Codes are computed from
keys and amounts, so that every code, missing value and unmatched label occurs.
"""

from microtally.operators import curate
from microtally.session import scratch_path
from workload.registry import read

YEAR = 2024
BATCH = "batch-1"

# Each role as SQL over the test tables; Spark reads the same text where it is a plain
# projection, DuckDB always does.
STAGING_SQL = {
    "v1_household": """
        SELECT c_custkey AS hhid, CAST(n_regionkey + 1 AS bigint) AS reg, CAST(n_regionkey + 1 AS bigint) AS reg2,
               CAST(n_nationkey AS bigint) AS prv, c_custkey % 4 AS urbanity, c_custkey % 11 AS psu,
               CAST(1 AS bigint) AS intvw, c_acctbal + 1000 AS rfact
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v1_household_questions": """
        SELECT c_custkey AS hhid, CAST(c_nationkey AS bigint) AS prv,
               c_custkey % 3 AS beneficiary_4ps, CAST(1 + c_nationkey % 2 AS bigint) AS electricity,
               1 + c_custkey % 2 AS hh_smartphone,
               CAST(CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END AS bigint) AS hh_basicphone,
               CAST(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 2 END AS bigint) AS hh_pc,
               CAST(CASE WHEN c_custkey % 13 = 12 THEN 9 WHEN c_custkey % 13 < 6 THEN 1 ELSE 2 END AS bigint) AS hh_tablet,
               CAST(CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 1
                         WHEN c_mktsegment = 'FURNITURE' THEN 9 ELSE 2 END AS bigint) AS hh_cabnet,
               c_custkey % 4 AS hh_nocabnet,
               CAST(CASE WHEN c_acctbal > 0 THEN 1 ELSE 2 END AS bigint) AS hh_mobsub,
               CAST(CASE WHEN c_custkey % 7 < 3 THEN 1 ELSE 2 END AS bigint) AS ict_equip,
               c_acctbal + 1000 AS hh_rfact
        FROM customer""",
    "v1_member": """
        SELECT o_custkey AS hhid, o_orderkey AS lno,
               CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS bigint) AS sex,
               CAST(floor(o_totalprice) AS bigint) % 100 AS age, o_orderkey % 7 AS rel,
               CASE WHEN o_orderkey % 10 > 0 THEN CAST(substr(o_orderpriority, 1, 1) AS bigint) END AS hgc_level,
               o_orderkey % 6 AS attend_school, o_totalprice AS mem_rfact
        FROM orders""",
    "order_lines": """
        SELECT l_orderkey, max(l_linenumber) AS l_linenumber, min(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey,
               sum(l_quantity) AS l_quantity, max(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus
        FROM lineitem GROUP BY l_orderkey""",
    "v1_literacy": """
        SELECT o_custkey AS hhid, l_orderkey AS lno_f2, CAST(l_linenumber AS bigint) AS result_code_f2,
               CAST(floor(o_totalprice) AS bigint) % 100 AS age_f2,
               CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS bigint) AS reading,
               CAST(CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 END AS bigint) AS reading59,
               CAST(CASE WHEN l_quantity > 90 THEN 1 WHEN l_quantity > 20 THEN 2 END AS bigint) AS writing,
               l_partkey % 3 AS writing59,
               CAST(CASE WHEN l_linenumber < 4 THEN l_linenumber END AS bigint) AS compute,
               l_suppkey % 4 AS compute59,
               l_partkey % 3 AS compre, CAST(l_linenumber % 5 AS bigint) AS fllevel,
               CAST(CASE WHEN l_returnflag = 'N' OR l_linenumber = 7 THEN NULL
                         WHEN l_quantity > 60 THEN 1 ELSE 2 END AS bigint) AS bliterate,
               CAST(CASE WHEN l_returnflag <> 'N' OR l_linenumber < 3 THEN 1 + l_partkey % 2 END AS bigint) AS fliterate,
               l_quantity AS resp_rfact_f2
        FROM order_lines JOIN orders ON o_orderkey = l_orderkey""",
    "codebook": """
        SELECT *, CAST(0 AS integer) AS volume FROM (
        SELECT 'hgc_level' AS variable, CAST(substr(o_orderpriority, 1, 1) AS bigint) AS value_from,
               CAST(substr(o_orderpriority, 1, 1) AS bigint) AS value_to, o_orderpriority AS value_label,
               CAST(1 AS bigint) AS row
        FROM orders GROUP BY o_orderpriority
        UNION ALL
        SELECT 'sex', CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END,
               CASE o_orderstatus WHEN 'F' THEN '1 - Female' ELSE '2 - Male' END, 2
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus
        UNION ALL
        SELECT 'urbanity', r_regionkey + 1, r_regionkey + 1, concat('0', r_regionkey + 1, ' - ', r_name), 3
        FROM region WHERE r_regionkey < 3
        UNION ALL
        SELECT 'fllevel', r_regionkey, r_regionkey, concat(r_regionkey, ' - ', r_name), 4
        FROM region WHERE r_regionkey < 4
        UNION ALL
        SELECT 'result_code_f2', n_nationkey, n_nationkey, concat('0', n_nationkey, ' - ', n_name), 5
        FROM nation WHERE n_nationkey BETWEEN 1 AND 6
        UNION ALL
        SELECT 'age', 0, 98, r_name, 6 FROM region) AS main_volume
        UNION ALL
        SELECT 'fllevel', CAST(r_regionkey AS bigint), CAST(r_regionkey AS bigint), concat(r_regionkey, ' - revised ', r_name),
               CAST(1 AS bigint), CAST(1 AS integer) FROM region WHERE r_regionkey IN (1, 2)""",
    "dim_region": """
        SELECT CAST(r_regionkey + 1 AS bigint) AS region_code, concat('Region ', r_regionkey + 1, ' - ', r_name) AS region_name,
               r_name AS region_short_name FROM region""",
}

LABEL = r"trim(regexp_replace(value_label, '^\s*\d+\s*-?\s*', ''))"


def _yes(code):
    return f"CASE {code} WHEN 1 THEN true WHEN 2 THEN false END"


AGE_BAND = """CASE WHEN {0} < 0 OR {0} >= 200 THEN NULL WHEN {0} < 10 THEN '0-9' WHEN {0} < 15 THEN '10-14'
    WHEN {0} < 25 THEN '15-24' WHEN {0} < 35 THEN '25-34' WHEN {0} < 45 THEN '35-44' WHEN {0} < 55 THEN '45-54'
    WHEN {0} < 65 THEN '55-64' WHEN {0} >= 65 THEN '65+' END"""
TIER = """CASE WHEN {0} = 0 THEN 'No access' WHEN {0} IN (1, 2) THEN 'Low' WHEN {0} = 3 THEN 'Moderate'
    WHEN {0} IN (4, 5) THEN 'High' END"""

CURATED_SQL = {
    "household": f"""
        SELECT *, {TIER.format('digital_access_score')} AS digital_access_tier FROM (
        SELECT *, CAST(owns_smartphone AS bigint) + CAST(owns_computer AS bigint) + CAST(owns_tablet AS bigint)
                  + CAST(has_home_internet AS bigint) + CAST(has_mobile_subscription AS bigint) AS digital_access_score
        FROM (
        SELECT {YEAR} AS survey_year, h.hhid, reg AS region_code, reg2 AS region_code_nir, h.prv AS province_code, psu,
               u.label AS urbanity, {_yes('beneficiary_4ps')} AS is_4ps_beneficiary,
               {_yes('electricity')} AS has_electricity, {_yes('hh_smartphone')} AS owns_smartphone,
               {_yes('hh_basicphone')} AS owns_basic_phone, {_yes('hh_pc')} AS owns_computer,
               {_yes('hh_tablet')} AS owns_tablet, {_yes('hh_cabnet')} AS has_internet_cable,
               {_yes('hh_nocabnet')} AS has_internet_no_cable,
               ({_yes('hh_cabnet')}) OR ({_yes('hh_nocabnet')}) AS has_home_internet,
               {_yes('hh_mobsub')} AS has_mobile_subscription, {_yes('ict_equip')} AS used_ict_for_learning,
               CAST(rfact AS decimal(14, 8)) AS household_weight, '{BATCH}' AS batch_id
        FROM v1_household h JOIN v1_household_questions q ON h.hhid = q.hhid
        LEFT JOIN labels_of u ON u.variable = 'urbanity' AND u.code = h.urbanity) flags) scored""",
    "member": f"""
        SELECT {YEAR} AS survey_year, hhid, lno AS line_no, s.label AS sex, nullif(age, 99) AS age,
               {AGE_BAND.format('nullif(age, 99)')} AS age_group, rel AS relationship_code,
               hgc_level AS education_level_code, e.label AS education_level,
               CASE WHEN attend_school IN (1, 2, 3) THEN true WHEN attend_school = 4 THEN false END AS attending_school,
               CAST(mem_rfact AS decimal(14, 8)) AS member_weight, '{BATCH}' AS batch_id
        FROM v1_member
        LEFT JOIN labels_of s ON s.variable = 'sex' AND s.code = sex
        LEFT JOIN labels_of e ON e.variable = 'hgc_level' AND e.code = hgc_level""",
    "literacy_assessment": f"""
        SELECT {YEAR} AS survey_year, hhid, lno_f2 AS line_no, result_code_f2 AS result_code, r.label AS result,
               result_code_f2 = 1 AS interview_completed, {_yes('coalesce(reading, reading59)')} AS can_read,
               {_yes('coalesce(writing, writing59)')} AS can_write, {_yes('coalesce(compute, compute59)')} AS can_compute,
               {_yes('compre')} AS can_comprehend, fllevel AS functional_literacy_level_code,
               f.label AS functional_literacy_level, {_yes('bliterate')} AS basic_literate,
               {_yes('fliterate')} AS functional_literate, CAST(resp_rfact_f2 AS decimal(14, 8)) AS respondent_weight,
               '{BATCH}' AS batch_id
        FROM v1_literacy
        LEFT JOIN labels_of r ON r.variable = 'result_code_f2' AND r.code = result_code_f2
        LEFT JOIN labels_of f ON f.variable = 'fllevel' AND f.code = fllevel""",
    "person_profile": """
        SELECT m.survey_year, m.hhid, m.line_no, m.sex, m.age, m.age_group, m.relationship_code, m.education_level_code,
               m.education_level, m.attending_school, m.member_weight, h.region_code, h.urbanity, h.has_electricity,
               h.owns_smartphone, h.owns_computer, h.owns_tablet, h.has_home_internet, h.has_mobile_subscription,
               h.used_ict_for_learning, h.digital_access_score, h.digital_access_tier, h.household_weight,
               l.interview_completed, l.basic_literate, l.functional_literate, l.functional_literacy_level,
               l.respondent_weight, d.region_name
        FROM member m
        LEFT JOIN household h ON h.survey_year = m.survey_year AND h.hhid = m.hhid
        LEFT JOIN literacy_assessment l ON l.survey_year = m.survey_year AND l.hhid = m.hhid AND l.line_no = m.line_no
        LEFT JOIN dim_region d ON d.region_code = h.region_code""",
    "agg_literacy_digital": f"""
        SELECT {YEAR} AS survey_year, region_code, age_group, digital_access_tier, count(*) AS persons_sampled,
               CAST(round(sum(respondent_weight), 2) AS decimal(16, 2)) AS weighted_population,
               round(100 * coalesce(sum(respondent_weight) FILTER (WHERE functional_literate), 0)
                     / nullif(sum(respondent_weight) FILTER (WHERE functional_literate IS NOT NULL), 0), 2)
                   AS functional_literacy_rate,
               round(100 * coalesce(sum(respondent_weight) FILTER (WHERE basic_literate), 0)
                     / nullif(sum(respondent_weight) FILTER (WHERE basic_literate IS NOT NULL), 0), 2)
                   AS basic_literacy_rate, '{BATCH}' AS batch_id
        FROM person_profile
        WHERE functional_literate IS NOT NULL AND region_code IS NOT NULL AND age_group IS NOT NULL
          AND digital_access_tier IS NOT NULL
        GROUP BY region_code, age_group, digital_access_tier""",
}

LABELS_OF = f"SELECT variable, value_from AS code, arg_max({LABEL}, 1000 * volume + row) AS label FROM codebook WHERE value_from = value_to GROUP BY 1, 2"
ROLE_SQL = {**STAGING_SQL, "labels_of": LABELS_OF, **CURATED_SQL}
NEEDS = {
    "v1_literacy": ["order_lines"],
    "labels_of": ["codebook"],
    "household": ["v1_household", "v1_household_questions", "labels_of"],
    "member": ["v1_member", "labels_of"],
    "literacy_assessment": ["v1_literacy", "labels_of"],
    "person_profile": ["household", "member", "literacy_assessment", "dim_region"],
    "agg_literacy_digital": ["person_profile"],
}


def with_roles(*names, sql):
    """Reference SQL that may use the named roles as tables."""
    wanted = []

    def need(name):
        for other in NEEDS.get(name, []):
            need(other)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        need(name)
    definitions = ",\n".join(f"{name} AS ({ROLE_SQL[name]})" for name in wanted)
    joiner = ",\n" if sql.lstrip().upper().startswith("WITH ") else "\n"
    body = sql.lstrip()[5:] if joiner.startswith(",") else sql
    return f"WITH {definitions}{joiner}{body}"


# ---------- the same roles as frames ----------

SOURCES = {
    "v1_household": ["customer", "nation"],
    "v1_household_questions": ["customer"],
    "v1_member": ["orders"],
    "codebook": ["orders", "region", "nation"],
    "dim_region": ["region"],
}


def staged(spark, sf_dir, role):
    """A staging role as a frame."""
    if role == "v1_literacy":
        return _literacy(spark, sf_dir)
    if role == "codebook":
        return _codebook(spark, sf_dir)
    return _projected(spark, sf_dir, role)


def _projected(spark, sf_dir, role):
    for table in SOURCES[role]:
        read(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(STAGING_SQL[role])


_CODEBOOKS = {}


def _codebook(spark, sf_dir):
    """The codebook as a written table, like in a run; derived once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CODEBOOKS:
        path = scratch_path(spark, "codebook")
        _projected(spark, sf_dir, "codebook").coalesce(1).write.parquet(path)
        _CODEBOOKS[key] = spark.read.parquet(path)
    return _CODEBOOKS[key]


def _literacy(spark, sf_dir):
    for table in ("lineitem", "orders"):
        read(spark, sf_dir, table).createOrReplaceTempView(table)
    spark.sql(STAGING_SQL["order_lines"]).createOrReplaceTempView("order_lines")
    return spark.sql(STAGING_SQL["v1_literacy"])


def dim_region(spark, sf_dir):
    return staged(spark, sf_dir, "dim_region")


def household(spark, sf_dir):
    return curate.build_household(
        staged(spark, sf_dir, "v1_household"), staged(spark, sf_dir, "v1_household_questions"),
        staged(spark, sf_dir, "codebook"), YEAR, BATCH,
    )


def member(spark, sf_dir):
    return curate.build_member(staged(spark, sf_dir, "v1_member"), staged(spark, sf_dir, "codebook"), YEAR, BATCH)


def assessment(spark, sf_dir):
    return curate.build_assessment(staged(spark, sf_dir, "v1_literacy"), staged(spark, sf_dir, "codebook"), YEAR, BATCH)


def person_profile(spark, sf_dir):
    return curate.build_person_profile(
        household(spark, sf_dir), member(spark, sf_dir), assessment(spark, sf_dir), dim_region(spark, sf_dir)
    )


def aggregate(spark, sf_dir):
    return curate.build_aggregate(person_profile(spark, sf_dir), YEAR, BATCH)
