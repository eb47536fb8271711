"""Names, cells, types, line numbers and de-duplication."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from microtally.errors import DuplicateShareError, SourceError
from microtally.functions.text import clean_column_name, clean_name, strip, strip_label_prefix, to_number
from microtally.operators import staging
from microtally.operators.ordered import fill_down
from microtally.sources import codebook, text_tables


def test_column_names(spark):
    names = {"\ufeffKennung": "kennung", "  Net price [EUR/kg] ": "net_price_eur_kg", "--x..Y--": "x_y", "größe 2": "gr_e_2", "a\ufeffB": "ab"}
    for raw, clean in names.items():
        assert clean_column_name(raw) == clean
    df = spark.createDataFrame(list(names.items()), "raw string, clean string")
    assert df.where(clean_name(F.col("raw")) != F.col("clean")).count() == 0


def test_colliding_names_are_an_error(spark):
    for header in (["Unit-1", "unit 1"], ["ok", "???"]):
        with pytest.raises(SourceError):
            staging.standardise(spark.createDataFrame([("1", "2")], header))


def test_standardise(spark):
    df = spark.createDataFrame([("\u00a0north", "\x0b", "7 7"), ("south\n", "", "\t8 ")], ["Wing", "Room.No", "DESK %"])
    out = staging.standardise(df)
    assert out.columns == ["wing", "room_no", "desk"]
    assert {tuple(row) for row in out.collect()} == {("north", None, "7 7"), ("south", None, "8")}


def test_strip_removes_what_python_removes(spark):
    cells = [f"{chr(c)}x{chr(c)}" for c in range(1, 0x3001) if chr(c).isspace()]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert df.where(strip(F.col("c")) != "x").count() == 0


BIG = 12345678901234567890


@pytest.mark.parametrize("cells, kind, values", [
    (["-41", None, "+7"], "bigint", [-41, None, 7]),
    (["0.25", "6", None], "double", [0.25, 6.0, None]),
    (["12b", "12", "0"], "string", ["12b", "12", "0"]),
    (["0007", "8"], "bigint", [7, 8]),
    (["4.", "2.50e2", "-1E0"], "bigint", [4, 250, -1]),
    (["-.75", "5E-1"], "double", [-0.75, 0.5]),
    (["3L", "3"], "string", ["3L", "3"]),
    (["nan"], "string", ["nan"]),
    (["0b11", "1"], "string", ["0b11", "1"]),
    (["2_5"], "string", ["2_5"]),
    (["-inf", "1"], "string", ["-inf", "1"]),
    ([None], "string", [None]),
    (["18014398509481985", "1"], "bigint", [18014398509481985, 1]),
    (["9223372036854775806", "9223372036854775807"], "bigint", [2**63 - 2, 2**63 - 1]),
    (["-9223372036854775808"], "bigint", [-(2**63)]),
    (["9223372036854775808", "5"], "decimal(38,0)", [Decimal(2**63), Decimal(5)]),
    ([str(BIG), str(BIG + 1)], "decimal(38,0)", [Decimal(BIG), Decimal(BIG + 1)]),
    (["9.2e18", "1"], "bigint", [9_200_000_000_000_000_000, 1]),
    (["5e20", "1.0"], "decimal(38,0)", [Decimal(5 * 10**20), Decimal(1)]),
    ([f"{BIG}.5", "1"], "double", [BIG + 0.5, 1.0]),
    ([str(BIG), "0.5"], "string", [str(BIG), "0.5"]),
    (["1" * 39, "1"], "string", ["1" * 39, "1"]),
    (["1e40", "1"], "string", ["1e40", "1"]),
])
def test_types(spark, cells, kind, values):
    df = spark.createDataFrame([(c,) for c in cells], "c string").coalesce(1)
    typed, _ = staging.convert_types(df)
    assert typed.dtypes == [("c", kind)]
    assert [row.c for row in typed.collect()] == values


def test_large_keys_stay_apart(spark):
    rows = [(str(BIG), "a"), (str(BIG + 1), "b"), ("9223372036854775806", "c"), ("9223372036854775807", "d")]
    data = [(*row, "f.csv", line) for line, row in enumerate(rows, 2)]
    for some in (data[:2], data[2:], data):
        text = spark.createDataFrame(some, "k string, v string, source_file string, source_line long")
        typed, _ = staging.convert_types(text, keep_text=["source_file"])
        result = staging.deduplicate(typed, ["k"], ["k", "v"])
        assert result.kept.count() == len(some) and result.rejects.count() == 0


def test_columns_kept_as_text(spark):
    df = spark.createDataFrame([("007", "7"), ("008", "8")], ["badge", "floor"])
    typed, converted = staging.convert_types(df, keep_text=["badge"])
    assert converted == {"floor": "long"} and [row.badge for row in typed.orderBy("floor").collect()] == ["007", "008"]


def test_to_number_and_labels(spark):
    df = spark.createDataFrame([("\t-3.5e1", "7-  Never"), ("1,5", " 12 Often "), (None, "rarely 3")], "n string, l string").coalesce(1)
    assert [row[0] for row in df.select(to_number(F.col("n"))).collect()] == [-35.0, None, None]
    assert [row[0] for row in df.select(strip_label_prefix(F.col("l"))).collect()] == ["Never", "Often", "rarely 3"]


# Readings of meters: one is sent three times, one twice with another value, one has no meter.
ROWS = [(70, 1, 5), (70, 2, 6), (70, 1, 5), (71, 1, 9), (71, 1, 8), (70, 1, 5), (None, 3, 1)]


def numbered(spark, rows, schema="meter long, day long, reading long"):
    data = [(*row, "f.csv", line) for line, row in enumerate(rows, 2)]
    return spark.createDataFrame(data, f"{schema}, source_file string, source_line long").repartition(4)


def test_deduplicate(spark):
    result = staging.deduplicate(numbered(spark, ROWS), ["meter", "day"], ["meter", "day", "reading"])
    assert result.stats.first().asDict() == {
        "rows_in": 7, "exact_duplicates_removed": 2, "rows_sharing_a_key": 2, "key_duplicates_removed": 1, "rows_out": 4}
    kept = {(r.meter, r.day, r.reading, r.source_line) for r in result.kept.collect()}
    assert kept == {(70, 1, 5, 2), (70, 2, 6, 3), (71, 1, 9, 5), (None, 3, 1, 8)}
    assert {(r.meter, r.reading, r.source_line) for r in result.rejects.collect()} == {(71, 9, 5), (71, 8, 6)}
    assert result.kept.columns == ["meter", "day", "reading", "source_file", "source_line"]


def test_deduplicate_treats_null_keys_as_equal(spark):
    rows = [(None, None, 4), (None, None, 5), (None, None, 5), (None, 2, 4)]
    result = staging.deduplicate(numbered(spark, rows), ["meter", "day"], ["meter", "day", "reading"])
    assert sorted((r.day is None, r.reading) for r in result.kept.collect()) == [(False, 4), (True, 4)]
    assert result.rejects.count() == 2 and result.stats.first().exact_duplicates_removed == 1


def test_deduplicate_an_empty_table(spark):
    result = staging.deduplicate(numbered(spark, ROWS).limit(0), ["meter"], ["meter", "day", "reading"])
    assert result.stats.first().rows_in == 0 and result.kept.count() == 0


def test_deduplicate_needs_its_key(spark):
    with pytest.raises(SourceError, match="person"):
        staging.deduplicate(numbered(spark, ROWS), ["person"], ["meter"])


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(90_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id % 7 AS v", "'f' AS source_file", "id AS source_line")
    result = staging.deduplicate(rows, ["k"], ["k", "v"])
    stats = result.stats.first()
    assert (stats.rows_in, stats.rows_out) == (90_000, 60_001)
    assert stats.rows_sharing_a_key == 7 and result.rejects.count() == 7
    assert "Cartesian" not in result.rejects._jdf.queryExecution().executedPlan().toString()
    plan = result.keyed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") == 1 and "Window" not in plan


def test_first_rows_tell_what_all_rows_tell(spark):
    rows = [(k, a, b) for k in (None, 1, 2, 3) for a in (None, 0.0, -0.0, float("nan")) for b in (None, "x", "x", "y")][:-9]
    rows += [(5, -0.0, "z"), (6, float("nan"), None), (6, float("nan"), None), (None, None, None)]
    table = numbered(spark, rows, "k long, a double, b string")
    result = staging.deduplicate(table, ["k"], ["k", "a", "b"])
    keyed = {(r.k, str(r._first), r.copies, r.sharing > 1) for r in result.keyed.collect()}
    firsts = [(r.k, str(r._first), r.copies, r.shared) for r in result.firsts.collect()]
    assert set(firsts) == keyed and len(firsts) == len(keyed)
    assert {k: shared for k, _, _, shared in firsts} == {None: True, 1: True, 2: True, 3: True, 5: False, 6: False}
    plan = result.kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_the_key_may_be_all_there_is(spark):
    table = numbered(spark, ROWS).select("meter", "source_line")
    result = staging.deduplicate(table, ["meter"], ["meter"], ["source_line"])
    assert {(r.meter, r.source_line) for r in result.kept.collect()} == {(70, 2), (71, 5), (None, 8)}
    assert result.rejects.count() == 0 and not any(r.shared for r in result.firsts.collect())


def test_parts_of_a_large_table_add_up(spark, monkeypatch):
    rows = [*ROWS, (None, None, 4), (None, None, 5), *[(i % 50, i % 3, i % 7) for i in range(300)]]
    whole = staging.deduplicate(numbered(spark, rows), ["meter", "day"], ["meter", "day", "reading"])
    monkeypatch.setattr(staging, "PART_FROM_BYTES", 0)
    parts = whole.parts()
    assert len(parts) == staging.PARTS > 1
    for made in ("kept", "rejects", "stats"):
        of_parts = [getattr(part, made).collect() for part in parts]
        if made == "stats":
            assert tuple(map(sum, zip(*[found[0] for found in of_parts]))) == tuple(whole.stats.first())
        else:
            assert sorted(map(str, sum(of_parts, []))) == sorted(map(str, getattr(whole, made).collect()))
            assert sum(map(bool, of_parts)) > 1
    assert sorted(map(str, whole.stored().collect())) == sorted(map(str, whole.kept.collect()))


def test_a_small_table_is_one_part(spark, tmp_path):
    numbered(spark, ROWS).write.parquet(str(tmp_path / "t"))
    small = staging.deduplicate(spark.read.parquet(str(tmp_path / "t")), ["meter", "day"], ["meter", "day", "reading"])
    assert small.parts() == [small]


def test_duplicate_share():
    assert staging.check_duplicate_share("t", {"rows_in": 5000, "rows_out": 4950}) == pytest.approx(0.01)
    with pytest.raises(DuplicateShareError, match="51 of 5,000"):
        staging.check_duplicate_share("t", {"rows_in": 5000, "rows_out": 4949})
    assert staging.check_duplicate_share("t", {"rows_in": 5000, "rows_out": 4000}, limit=0.2) == pytest.approx(0.2)
    assert staging.check_duplicate_share("t", {"rows_in": 0, "rows_out": 0}) == 0


def test_source_lines_follow_the_file_over_many_blocks(spark, tmp_path):
    expected = {}
    for name, rows in (("a.csv", 20_000), ("b.csv", 3)):
        text = "".join(f"{name}-{i},{'x' * (i % 90)}\n" for i in range(rows))
        (tmp_path / name).write_text("id,pad\n" + text)
        expected.update({f"{name}-{i}": i + 2 for i in range(rows)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        numbered_rows = text_tables.read_numbered_table(spark, str(tmp_path))
        assert numbered_rows.rdd.getNumPartitions() > 10
        found = {row.id: row.source_line for row in numbered_rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == expected


def test_rows_are_numbered_where_they_are(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n" + "".join(f"{i}\n" for i in range(500)))
    numbered_rows = text_tables.read_numbered_table(spark, str(tmp_path / "a.csv"))
    assert all(row.source_line == int(row.id) + 2 for row in numbered_rows.collect())
    plan = numbered_rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_many_blocks_are_numbered_without_a_broadcast(spark, tmp_path, monkeypatch):
    for name in "abc":
        (tmp_path / f"{name}.csv").write_text("id\n" + "".join(f"{i}\n" for i in range(400)))
    monkeypatch.setattr(text_tables, "BROADCAST_BYTES", 100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered_rows = text_tables.read_numbered_table(spark, str(tmp_path))
        assert "BroadcastHashJoin" not in numbered_rows._jdf.queryExecution().executedPlan().toString()
        rows = numbered_rows.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(rows) == 1200 and all(row.source_line == int(row.id) + 2 for row in rows)


def test_a_block_counted_differently_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n" + "".join(f"{i}\n" for i in range(50)))
    rows = text_tables.scan_blocks(spark, str(tmp_path / "a.csv"))
    blocks = text_tables.block_facts(rows)
    for wrong in (blocks.withColumn("_rows", F.col("_rows") - 1), blocks.withColumn("_first", F.col("_first") + 1), blocks.limit(0)):
        with pytest.raises(PySparkException, match="blocks changed"):
            text_tables.number_rows(rows, wrong).collect()


def test_text_scan_keeps_blanks_na_bom_and_quotes(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('﻿A,B,C\nNA,,"say ""hi"", ok"\n\n1,x\n'.encode())
    df = text_tables.scan_text(spark, str(path))
    assert df.columns == ["A", "B", "C"]
    assert {tuple(row) for row in df.collect()} == {("NA", "", 'say "hi", ok'), ("1", "x", "")}


def test_latin_1_file(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes("name\nPe\xf1a\n".encode("latin-1"))
    assert text_tables.scan_text(spark, str(path), "latin-1").first().name == "Pe\xf1a"


def test_fill_down_crosses_chunks(spark):
    rows = [(g, i, f"{g}{i}" if i % 13 == 5 else None) for g in "ab" for i in range(60)]
    df = spark.createDataFrame(rows, "g string, i long, v string").repartition(4)
    expected = {(g, i): (f"{g}{(i - 5) // 13 * 13 + 5}" if i >= 5 else None) for g in "ab" for i in range(60)}
    for chunk in (4, 7, 1000):
        found = {(r.g, r.i): r.v for r in fill_down(df, "g", "i", "v", chunk).collect()}
        assert found == expected


def test_codebook(spark):
    cells = [
        (1, "about this book", None, None, None, None),
        (2, "FUEL_VS1", " Main fuel ", None, None, None),
        (3, None, None, " 4 - Wood", "4", None),
        (4, None, None, "5 - Gas", "5.0", "6"),
        (5, None, None, "see notes", None, None),
        (6, "FLOOR AREA_VS2", None, None, None, None),
        (7, None, None, None, "10", "900"),
    ]
    sheet = spark.createDataFrame(cells, "row long, c0 string, c1 string, c2 string, c3 string, c4 string")
    book = codebook.parse_codebook(codebook.union_sheets({"v1": sheet, "v2": sheet.where("row < 4")}))
    rows = {(r.source, r.variable, r.variable_label, r.value_from, r.value_to, r.value_label) for r in book.collect()}
    assert rows == {
        ("v1", "fuel", "Main fuel", 4, 4, "4 - Wood"), ("v1", "fuel", "Main fuel", 5, 6, "5 - Gas"),
        ("v1", "floor_area", "", 10, 900, None), ("v2", "fuel", "Main fuel", 4, 4, "4 - Wood")}
    summary = codebook.codebook_summary(book).first()
    assert (summary.value_labels, summary.variables) == (4, 2)
