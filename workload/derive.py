"""Codes to business columns: flags, bands, scores, labels, table builders and joins."""

from pyspark.sql import functions as F

from microtally.functions.coded import any_flag, band, code_flag, complete_sum, lookup, sentinel_to_null, yes_no
from microtally.operators import curate, joins, load
from microtally.settings import ACCESS_TIERS, AGE_BANDS, AGE_TOP
from microtally.sources.codebook import decode, decode_by_join
from workload import roles
from workload.registry import query, read
from workload.roles import AGE_BAND, TIER, with_roles

YES = "CASE {0} WHEN 1 THEN true WHEN 2 THEN false END"


@query("decode_labels", r"""
    SELECT o_orderkey, trim(regexp_replace(o_orderpriority, '^\s*\d+\s*-?\s*', '')) AS label
    FROM orders""")
def decode_labels(spark, sf_dir):
    book = roles.staged(spark, sf_dir, "codebook")
    coded = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("long").alias("code")
    )
    return decode(coded, book, {"label": ("code", "hgc_level")}).drop("code")


@query("decode_labels_join", r"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0
           THEN trim(regexp_replace(o_orderpriority, '^\s*\d+\s*-?\s*', '')) END AS label
    FROM orders""")
def decode_labels_join(spark, sf_dir):
    book = roles.staged(spark, sf_dir, "codebook")
    members = roles.staged(spark, sf_dir, "v1_member")
    return decode_by_join(members, book, "hgc_level", "hgc_level", "label").select(
        F.col("lno").alias("o_orderkey"), "label"
    )


@query("decode_two_volumes", r"""
    SELECT n_nationkey, CASE WHEN n_nationkey = 0 THEN r_name WHEN n_nationkey IN (1, 2) THEN concat('revised ', r_name)
                             WHEN n_nationkey = 3 THEN r_name END AS label
    FROM nation LEFT JOIN region ON r_regionkey = n_nationkey""")
def decode_two_volumes(spark, sf_dir):
    """Codes 1 and 2 have another label in the later volume, on a row with a smaller number."""
    book = roles.staged(spark, sf_dir, "codebook")
    return decode(read(spark, sf_dir, "nation").select("n_nationkey"), book, {"label": ("n_nationkey", "fllevel")})


@query("yes_no", f"""
    SELECT l_linenumber, {YES.format('l_linenumber')} AS flag, l_linenumber = 1 AS completed, count(*) AS n
    FROM lineitem GROUP BY l_linenumber""")
def yes_no_query(spark, sf_dir):
    code = F.col("l_linenumber")
    return read(spark, sf_dir, "lineitem").groupBy(code, yes_no(code).alias("flag"), (code == 1).alias("completed")).agg(
        F.count("*").alias("n")
    )


@query("age_band", f"SELECT p_partkey, {AGE_BAND.format('p_size * 3 - 10')} AS age_group FROM part")
def age_band(spark, sf_dir):
    age = F.col("p_size") * 3 - 10
    return read(spark, sf_dir, "part").select("p_partkey", band(age, AGE_BANDS, AGE_TOP).alias("age_group"))


@query("band_range_join", """
    SELECT o_orderkey, CASE WHEN o_totalprice < 0 OR o_totalprice >= 400000 THEN NULL
           WHEN o_totalprice < 47500 THEN 'small' WHEN o_totalprice < 151234 THEN 'medium' ELSE 'large' END AS size_band
    FROM orders""")
def band_range_join(spark, sf_dir):
    bounds = [("small", 0, 47500), ("medium", 47500, 151234), ("large", 151234, 400000)]
    bands = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("label"), F.lit(low).alias("lower"), F.lit(high).alias("upper"))
        for name, low, high in bounds
    ])))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return joins.band_join(orders, "o_totalprice", bands, "size_band", 50000).drop("o_totalprice")


@query("sentinel_null", "SELECT p_partkey, nullif(p_size, 50) AS size FROM part")
def sentinel_null(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", sentinel_to_null(F.col("p_size"), 50).alias("size"))


QUESTIONS = with_roles("v1_household_questions", sql=f"""
    SELECT hhid, ({YES.format('hh_cabnet')}) OR ({YES.format('hh_nocabnet')}) AS has_home_internet
    FROM v1_household_questions""")


@query("kleene_or", QUESTIONS)
def kleene_or(spark, sf_dir):
    questions = roles.staged(spark, sf_dir, "v1_household_questions")
    flag = any_flag(yes_no(F.col("hh_cabnet")), yes_no(F.col("hh_nocabnet")))
    return questions.select("hhid", flag.alias("has_home_internet"))


PARTS = ["hh_smartphone", "hh_pc", "hh_tablet", "hh_nocabnet", "hh_mobsub"]
SCORE_SQL = " + ".join(f"CAST({YES.format(part)} AS bigint)" for part in PARTS)


def score():
    return complete_sum(*[yes_no(F.col(part)) for part in PARTS])


@query("access_score", with_roles("v1_household_questions", sql=f"""
    SELECT hhid, {SCORE_SQL} AS score FROM v1_household_questions"""))
def access_score(spark, sf_dir):
    return roles.staged(spark, sf_dir, "v1_household_questions").select("hhid", score().alias("score"))


@query("access_tier", with_roles("v1_household_questions", sql=f"""
    SELECT tier, count(*) AS n FROM (SELECT {TIER.format(f'({SCORE_SQL})')} AS tier FROM v1_household_questions)
    GROUP BY tier"""))
def access_tier(spark, sf_dir):
    questions = roles.staged(spark, sf_dir, "v1_household_questions")
    return questions.groupBy(lookup(score(), ACCESS_TIERS).alias("tier")).agg(F.count("*").alias("n"))


@query("attendance_flag", with_roles("v1_member", sql="""
    SELECT lno, CASE WHEN attend_school IN (1, 2, 3) THEN true WHEN attend_school = 4 THEN false END AS attending
    FROM v1_member"""))
def attendance_flag(spark, sf_dir):
    members = roles.staged(spark, sf_dir, "v1_member")
    return members.select("lno", code_flag(F.col("attend_school"), [1, 2, 3], [4]).alias("attending"))


@query("coalesce_flag", with_roles("v1_literacy", sql=f"""
    SELECT lno_f2, {YES.format('coalesce(reading, reading59)')} AS can_read,
           {YES.format('coalesce(writing, writing59)')} AS can_write FROM v1_literacy"""))
def coalesce_flag(spark, sf_dir):
    return roles.staged(spark, sf_dir, "v1_literacy").select(
        "lno_f2",
        yes_no(F.coalesce("reading", "reading59")).alias("can_read"),
        yes_no(F.coalesce("writing", "writing59")).alias("can_write"),
    )


# Customers as records of a region list: a code of ten digits, a designation, a name.
RECORDS_SQL = """
    SELECT CAST(c_custkey AS varchar) AS code, c_name AS name,
           CASE WHEN c_custkey % 3 = 0 THEN concat('Region ', c_custkey % 17) ELSE c_mktsegment END AS "regionName",
           lower(n_name) AS "islandGroupCode",
           concat(lpad(CAST(c_custkey % 19 + 1 AS varchar), 2, '0'), lpad(CAST(c_custkey AS varchar), 8, '0'))
               AS "psgc10DigitCode"
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def region_records(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").join(
        read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    designation = F.when(key % 3 == 0, F.concat(F.lit("Region "), key % 17)).otherwise(F.col("c_mktsegment"))
    digits = F.concat(F.lpad((key % 19 + 1).cast("string"), 2, "0"), F.lpad(key.cast("string"), 8, "0"))
    return customers.select(
        key.cast("string").alias("code"),
        F.col("c_name").alias("name"),
        designation.alias("regionName"),
        F.lower("n_name").alias("islandGroupCode"),
        digits.alias("psgc10DigitCode"),
    )


@query("dim_region", f"""
    SELECT CAST(substr("psgc10DigitCode", 1, 2) AS bigint) AS region_code,
           CASE WHEN "regionName" LIKE 'Region %' THEN concat("regionName", ' - ', name) ELSE "regionName" END AS region_name,
           name AS region_short_name,
           concat(upper(substr("islandGroupCode", 1, 1)), substr("islandGroupCode", 2)) AS island_group,
           "psgc10DigitCode" AS psgc_code
    FROM ({RECORDS_SQL})""")
def dim_region(spark, sf_dir):
    return curate.build_dim_region(region_records(spark, sf_dir))


@query("build_household", with_roles("household", sql="SELECT * FROM household"))
def build_household(spark, sf_dir):
    return roles.household(spark, sf_dir)


@query("build_member", with_roles("member", sql="SELECT * FROM member"))
def build_member(spark, sf_dir):
    return roles.member(spark, sf_dir)


@query("build_assessment", with_roles("literacy_assessment", sql="SELECT * FROM literacy_assessment"))
def build_assessment(spark, sf_dir):
    return roles.assessment(spark, sf_dir)


# ---------- joins ----------

@query("join_one_to_one", """
    SELECT o_orderkey, o_custkey, lines, quantity
    FROM orders JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)
      ON l_orderkey = o_orderkey""")
def join_one_to_one(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity")
    )
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.join_one_to_one(lines, orders, ["o_orderkey"])


@query("join_many_to_one", """
    SELECT o_orderkey, o_custkey AS c_custkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def join_many_to_one(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.join_many_to_one(orders, customers, ["c_custkey"])


# ---------- scalar functions ----------

@query("json_field", """
    SELECT event_id, props ->> '$.k' AS k_text, CAST(props ->> '$.k' AS bigint) AS k FROM events""")
def json_field(spark, sf_dir):
    text = F.get_json_object("props", "$.k")
    return read(spark, sf_dir, "events").select("event_id", text.alias("k_text"), text.cast("long").alias("k"))


@query("scalar_strings", r"""
    SELECT c_custkey, lower(c_name) AS lowered, substr(c_name, 1, 8) AS start,
           trim(regexp_replace(regexp_replace(lower(concat('  ', c_name, ' (', c_mktsegment, ') ')), '[^0-9a-z]+', '_', 'g'),
                '^_+|_+$', '', 'g')) AS cleaned,
           starts_with(c_mktsegment, 'B') AS b_segment, concat_ws('-', c_nationkey, c_custkey) AS cluster,
           split_part(c_name, '#', 2) AS number
    FROM customer""")
def scalar_strings(spark, sf_dir):
    from microtally.functions.text import clean_name

    wrapped = F.concat(F.lit("  "), "c_name", F.lit(" ("), "c_mktsegment", F.lit(") "))
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.lower("c_name").alias("lowered"),
        F.substring("c_name", 1, 8).alias("start"),
        clean_name(wrapped).alias("cleaned"),
        F.startswith("c_mktsegment", F.lit("B")).alias("b_segment"),
        F.concat_ws("-", F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")).alias("cluster"),
        F.split("c_name", "#")[1].alias("number"),
    )


NUMBER_SQL = r"regexp_full_match({0}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')"
MIXED_SQL = """CASE event_id % 7 WHEN 0 THEN concat(event_id, '') WHEN 1 THEN concat(' ', value, ' ')
    WHEN 2 THEN concat(event_id, 'd') WHEN 3 THEN 'NaN' WHEN 4 THEN concat(event_id % 100, 'e2')
    WHEN 5 THEN concat(event_id, '.0') ELSE '' END"""


@query("scalar_casts", f"""
    SELECT event_id, CASE WHEN {NUMBER_SQL.format('trim(t)')} THEN CAST(trim(t) AS double) END AS number,
           date_trunc('second', ts + INTERVAL '500 milliseconds') AS finished,
           sqrt(abs(value)) AS root, least(greatest(value, 1), 100) AS clipped
    FROM (SELECT *, {MIXED_SQL} AS t FROM events)""")
def scalar_casts(spark, sf_dir):
    from microtally.functions.text import to_number

    mixed = mixed_text(F.col("event_id"), F.col("value"))
    return read(spark, sf_dir, "events").select(
        "event_id",
        to_number(mixed).alias("number"),
        load.to_second(F.col("ts")).cast("timestamp_ntz").alias("finished"),
        F.sqrt(F.abs("value")).alias("root"),
        F.least(F.greatest("value", F.lit(1.0)), F.lit(100.0)).alias("clipped"),
    )


def mixed_text(key, value):
    """Cells as survey files have them: plain, padded, typed, blank and exponent numbers."""
    kind = key % 7
    return (
        F.when(kind == 0, key.cast("string"))
        .when(kind == 1, F.concat(F.lit(" "), value, F.lit(" ")))
        .when(kind == 2, F.concat(key, F.lit("d")))
        .when(kind == 3, F.lit("NaN"))
        .when(kind == 4, F.concat(key % 100, F.lit("e2")))
        .when(kind == 5, F.concat(key, F.lit(".0")))
        .otherwise(F.lit(""))
    )
