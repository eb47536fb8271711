"""Coded answers, labels, rates and table builders on small tables."""

import random
from bisect import bisect

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from microtally.functions.coded import any_flag, band, code_flag, complete_sum, lookup, sentinel_to_null, yes_no
from microtally.functions.weighted import weighted_rate, weighted_share
from microtally.operators import curate, joins, load, rates
from microtally.settings import ACCESS_TIERS, AGE_BANDS, AGE_TOP
from microtally.sources import codebook


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_yes_no(spark):
    df = spark.range(-1, 5).selectExpr("CASE WHEN id >= 0 THEN id END AS c").coalesce(1)
    assert column(df, yes_no(F.col("c"))) == [None, None, True, False, None, None]


def test_bands_cover_every_age_once(spark):
    df = spark.range(-3, AGE_TOP + 3).selectExpr("id AS a").coalesce(1)
    lows = [low for low, _ in AGE_BANDS]
    wanted = [AGE_BANDS[bisect(lows, age) - 1][1] if 0 <= age < AGE_TOP else None for age in range(-3, AGE_TOP + 3)]
    assert column(df, band(F.col("a"), AGE_BANDS, AGE_TOP)) == wanted
    assert column(spark.createDataFrame([(None,)], "a long"), band(F.col("a"), AGE_BANDS, AGE_TOP)) == [None]


def test_flags_of_three_values(spark):
    values = (True, False, None)
    rows = [(a, b, c) for a in values for b in values for c in values]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean").coalesce(1)
    flags = [F.col(name) for name in "abc"]
    assert column(df, any_flag(*flags)) == [True if True in row else None if None in row else False for row in rows]
    assert column(df, complete_sum(*flags)) == [None if None in row else sum(row) for row in rows]


def test_codes_become_tiers_flags_and_nulls(spark):
    df = spark.createDataFrame([(n,) for n in (*range(-1, 8), None)], "s long").coalesce(1)
    codes = [*range(-1, 8), None]
    assert column(df, lookup(F.col("s"), ACCESS_TIERS)) == [ACCESS_TIERS.get(code) for code in codes]
    assert column(df, code_flag(F.col("s"), [0, 6], [7])) == [{0: True, 6: True, 7: False}.get(code) for code in codes]
    assert column(df, sentinel_to_null(F.col("s"), 5)) == [None if code == 5 else code for code in codes]


BOOK = "source string, variable string, value_from long, value_to long, value_label string, row long, volume int"


def book(spark):
    """Two volumes: the second is later, though its rows have smaller numbers and its name sorts first."""
    return spark.createDataFrame([
        ("main", "roof", 1, 1, "1 - Tiles", 40, 0), ("main", "roof", 2, 2, "2 - Reed", 41, 0), ("main", "roof", 3, 3, "3 - Tin", 42, 0),
        ("main", "wall", 1, 1, "01 - Mud", 60, 0), ("main", "wall", 1, 1, "01 -  Brick ", 61, 0), ("main", "wall", 2, 2, "", 62, 0),
        ("main", "wall", 4, 4, "2x4 frame", 63, 0), ("main", "rooms", 1, 40, None, 70, 0),
        ("added", "roof", 2, 2, "2 - Thatch", 5, 1), ("added", "roof", 3, 3, "3 - Metal", 42, 1),
    ], BOOK)


def test_code_labels(spark):
    labels = codebook.label_maps(book(spark), ["roof", "wall", "rooms"])
    # The last entry of the last volume wins; a label that itself starts with a digit loses it.
    assert labels == {"roof": {1: "Tiles", 2: "Thatch", 3: "Metal"}, "wall": {1: "Brick", 4: "x4 frame"}, "rooms": {}}


@pytest.mark.parametrize("limit", [64, 1])
def test_decode_is_the_same_by_map_and_by_join(spark, monkeypatch, limit):
    monkeypatch.setattr(codebook, "INLINE_LABELS", limit)
    df = spark.createDataFrame([(1,), (2,), (9,), (None,)], "code long")
    decoded = codebook.decode(df, book(spark), {"label": ("code", "roof"), "other": ("code", "rooms")})
    assert {(r.code, r.label, r.other) for r in decoded.collect()} == {
        (1, "Tiles", None), (2, "Thatch", None), (9, None, None), (None, None, None)}


def test_weighted_rate(spark):
    draw = random.Random(8)
    rows = [(draw.choice([True, False, None]), draw.randrange(1, 500) / 4) for _ in range(300)]
    df = spark.createDataFrame(rows, "f boolean, w double")
    yes, no = (sum(w for flag, w in rows if flag is value) for value in (True, False))
    assert df.agg(weighted_rate(F.col("f"), F.col("w"))).first()[0] == pytest.approx(100 * yes / (yes + no), abs=0.01)
    empty = [df.where("f IS NULL"), df.limit(0)]
    assert [frame.agg(weighted_rate(F.col("f"), F.col("w"))).first()[0] for frame in empty] == [None, None]
    none = df.where("NOT f")
    assert none.agg(weighted_rate(F.col("f"), F.col("w")), weighted_share(F.col("f"), F.col("w"))).first()[:] == (0.0, None)


def test_dim_region(spark):
    regions = spark.createDataFrame([
        ("r13", "NCR", "National Capital Region", "luzon", "1300000000"),
        ("r05", "Bicol", "Region V", "luzon", "0500000000"),
    ], "code string, name string, regionName string, islandGroupCode string, psgc10DigitCode string")
    rows = sorted(tuple(row) for row in curate.build_dim_region(regions).collect())
    assert rows == [
        (5, "Region V - Bicol", "Bicol", "Luzon", "0500000000"),
        (13, "National Capital Region", "NCR", "Luzon", "1300000000")]


def test_one_to_one_join_fails_on_lost_or_repeated_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k long, l string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k long, r string")
    assert {tuple(r) for r in joins.join_one_to_one(left, right, ["k"]).collect()} == {(1, "a", "x"), (2, "b", "y")}
    with pytest.raises(PySparkException, match="lost rows"):
        joins.join_one_to_one(right, left, ["k"]).collect()
    with pytest.raises(PySparkException, match="not unique"):
        joins.join_one_to_one(left, right.union(right), ["k"]).collect()


def test_one_to_one_join_moves_whole_rows_once(spark):
    """Beside the keys that prove uniqueness, each side has one exchange, and no row is aggregated whole."""
    left = spark.range(50).selectExpr("id AS k", "concat('l', id) AS wide_left")
    right = spark.range(50).selectExpr("id AS k", "concat('r', id) AS wide_right")
    joined = joins.join_one_to_one(left.hint("merge"), right, ["k"])
    assert joined.count() == 50
    plan = joined._jdf.queryExecution().executedPlan().toString()
    main = plan[: plan.index("Subquery")] if "Subquery" in plan else plan
    assert "first(" not in plan and "Aggregate" not in main.split("Filter", 1)[0]
    with pytest.raises(PySparkException, match="left side.*not unique"):
        joins.join_one_to_one(left.union(left), right, ["k"]).collect()


def test_members_and_assessments_match_one_to_one(spark):
    with pytest.raises(PySparkException, match="member.*not unique"):
        joins.unique_by(spark.createDataFrame([(1, None), (1, None)], "a long, b long"), ["a", "b"], "member").collect()


def test_many_to_one_join_keeps_every_child(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (9, 3), (None, 4)], "k long, n long")
    parent = spark.createDataFrame([(1, "x"), (2, "y")], "k long, p string")
    rows = joins.join_many_to_one(child, parent, ["k"]).collect()
    assert {(r.n, r.p) for r in rows} == {(1, "x"), (2, "x"), (3, None), (4, None)}
    with pytest.raises(PySparkException, match="not unique"):
        joins.join_many_to_one(child, parent.union(parent), ["k"]).collect()


def test_band_join_equals_the_expression(spark):
    values = spark.range(-5, 230).selectExpr("id AS age")
    listed = [(low, (AGE_BANDS + [(AGE_TOP, "")])[i + 1][0], name) for i, (low, name) in enumerate(AGE_BANDS)]
    bands = spark.createDataFrame(listed, "lower long, upper long, label string")
    joined = joins.band_join(values, "age", bands, "by_join", 5)
    wrong = joined.where(~F.col("by_join").eqNullSafe(band(F.col("age"), AGE_BANDS, AGE_TOP)))
    assert joined.count() == 235 and wrong.count() == 0


@pytest.mark.parametrize("width", [1, 7, 10, 1000])
def test_bands_need_not_fit_their_cells(spark, width):
    values = spark.range(-5, 60).selectExpr("id AS v").unionAll(spark.sql("SELECT CAST(NULL AS bigint)"))
    bands = [(0, 15, "a"), (15, 25, "b"), (30, 31, "c"), (31, 55, "d")]
    joined = joins.band_join(values, "v", spark.createDataFrame(bands, "lower long, upper long, label string"), "band", width)
    wanted = {v: next((name for low, high, name in bands if low <= v < high), None) for v in range(-5, 60)}
    rows = joined.collect()
    assert len(rows) == 66 and {row.v: row.band for row in rows} == {**wanted, None: None}


def test_overlapping_bands_fail(spark):
    bands = spark.createDataFrame([(0, 20, "a"), (5, 7, "b"), (10, 12, "c")], "lower long, upper long, label string")
    with pytest.raises(PySparkException, match="overlap"):
        joins.band_join(spark.range(5).selectExpr("id AS v"), "v", bands, "band", 10).collect()


@pytest.mark.parametrize("how", ["left", "left_semi", "inner"])
def test_lookup_join_is_the_same_beyond_the_broadcast_size(spark, monkeypatch, how):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 50 = 1 THEN NULL ELSE id END AS k")
    table = spark.range(0, 3000, 2).selectExpr("CASE WHEN id > 10 THEN id + 1 END AS k", "concat('v', id) AS v").dropDuplicates(["k"])
    found = {}
    for limit in (1 << 30, 1):
        monkeypatch.setattr(joins, "small_enough", lambda frame, bound=0, limit=limit: limit > 1)
        joined = joins.lookup_join(df, table, ["k"], how)
        assert ("_salt" in joined._jdf.queryExecution().executedPlan().toString()) == (limit == 1)
        found[limit] = sorted(map(repr, joined.collect()))
    assert found[1] == found[1 << 30]


def test_size_of_a_lookup_is_measured_in_bytes(spark):
    wide = spark.range(1000).selectExpr("id AS k", "repeat('x', 1000) AS v")
    assert joins.small_enough(wide) and not joins.small_enough(wide, 100_000) and joins.small_enough(wide.select("k"), 100_000)


def test_skewed_parent_lookup_is_split_and_keeps_every_row(spark):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        child = spark.range(60_000).repartition(8).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS n")
        parent = spark.range(60_000).selectExpr("id AS k", "id * 2 AS p")
        joined = joins.join_many_to_one(child, parent, ["k"])
        assert len(joined.collect()) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        # The hot key is split too where a second join would reuse the placement of the first.
        second = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS n", "id + 1 AS q")
        chained = joins.join_many_to_one(joined, second, ["k", "n"])
        rows = chained.collect()
        assert len(rows) == 60_000 and all(row.q == row.n + 1 for row in rows)
        assert "skew=true" in chained._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_aggregate_drops_groups_with_a_missing_key(spark):
    rows = [(1, "10-14", "Low", True, None, 2.0), (1, "10-14", "Low", False, True, 1.0),
            (1, None, "Low", True, True, 5.0), (1, "10-14", "Low", None, True, 9.0)]
    schema = "region_code long, age_group string, digital_access_tier string, functional_literate boolean, " \
             "basic_literate boolean, respondent_weight double"
    row = curate.build_aggregate(spark.createDataFrame(rows, schema), 2024, "b").collect()
    assert len(row) == 1
    assert (row[0].persons_sampled, float(row[0].weighted_population)) == (2, 3.0)
    assert (row[0].functional_literacy_rate, row[0].basic_literacy_rate) == (66.67, 100.0)


def test_person_profile_keeps_unmatched_members_and_rejects_repeats(spark):
    household = spark.createDataFrame([(2024, 1, 3)], "survey_year int, hhid long, region_code long")
    for name in curate.PROFILE_HOUSEHOLD[3:]:
        household = household.withColumn(name, F.lit(None).cast("string"))
    member = spark.createDataFrame(
        [(2024, 1, 1, "b"), (2024, 7, 1, "b")], "survey_year int, hhid long, line_no long, batch_id string")
    test = spark.createDataFrame([(2024, 1, 1)], "survey_year int, hhid long, line_no long")
    for name in curate.PROFILE_ASSESSMENT[3:]:
        test = test.withColumn(name, F.lit(True))
    regions = spark.createDataFrame([(3, "Three")], "region_code long, region_name string")
    rows = curate.build_person_profile(household, member, test, regions).collect()
    assert {(r.hhid, r.region_name, r.basic_literate) for r in rows} == {(1, "Three", True), (7, None, None)}
    with pytest.raises(PySparkException, match="not unique"):
        curate.build_person_profile(household, member, test.union(test), regions).collect()


def test_null_sort_order_of_the_education_table(spark):
    literacy = spark.createDataFrame(
        [(2024, 1, 1, True, 1.0), (2024, 1, 2, False, 1.0), (2024, 1, 3, True, 1.0)],
        "survey_year int, hhid long, line_no long, functional_literate boolean, respondent_weight double")
    member = spark.createDataFrame(
        [(2024, 1, 1, 2, "College"), (2024, 1, 2, None, None), (2024, 1, 3, 0, "None")],
        "survey_year int, hhid long, line_no long, education_level_code long, education_level string")
    household = spark.createDataFrame([(2024, 1, "High")], "survey_year int, hhid long, digital_access_tier string")
    rows = rates.rate_by_education(literacy, member, household).collect()
    assert [r.education_level for r in rows] == [None, "None", "College"]
    assert [r.functional_literacy_rate_pct for r in rows] == [None, 100.0, 100.0]


def test_upsert_and_replace(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert {tuple(r) for r in load.upsert(old, new, ["k"]).collect()} == {(1, "a"), (2, "B"), (3, "C")}
    with pytest.raises(PySparkException, match="not unique"):
        load.upsert(old, new.union(new), ["k"]).collect()
    assert {tuple(r) for r in load.replace_period(old, new, "k", 2).collect()} == {(1, "a"), (2, "B"), (3, "C")}
