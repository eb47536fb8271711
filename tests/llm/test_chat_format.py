from microtally.llm import chat_format, operators  # noqa: F401
from microtally.llm.registry import ORACLES, QUERIES
from tests.llm.cases import SF_DIR, same_as_sql, tables
from workload.check import compare, connect

SCHEMA = "conv_id long, turn long, role string, text string, part int"
ROWS = [
    (1, 0, "system", "Be brief."), (1, 1, "ann", "Hello <|im_end|> there"), (1, 2, "bob", "Hi"), (1, 3, "ann", ""), (1, 3, "cy", "é🙂"),
    (1, 3, "cy", "é🙂"), (2, 0, "system", "alone"), (3, None, "ann", "when?"), (3, 5, None, "who?"), (3, 70, "bob", None),
    (None, 1, "ann", "where?"), (None, None, None, None), (4, 0, "assistant", "a"), (4, 1, "user", "b\nc")]


def test_whole_table(spark):
    assert compare(spark, connect(SF_DIR), QUERIES["op8_chat_format"], ORACLES["op8_chat_format"], SF_DIR) is None


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*row, 9) for row in rows], SCHEMA).repartition(3)


def test_awkward_rows_agree_with_sql(spark, tmp_path):
    turns = frame(spark)
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    same_as_sql(QUERIES["op8_chat_format"](spark, str(tmp_path)), tables({"conversations": turns}), ORACLES["op8_chat_format"])


def test_masks_hold_what_the_participant_says(spark):
    for row in chat_format.rotate_perspectives(frame(spark)).collect():
        said = [row.rendered[span.start:span.end] for span in row.spans]
        own = [text for conv, _, role, text in ROWS if conv == row.conv_id and role == row.perspective]
        assert all(piece.endswith("<|im_end|>") for piece in said)
        if row.conv_id == 1:
            assert sorted(said) == sorted((text or "").replace("<|im_", "<| im_") + "<|im_end|>" for text in own)
        assert row.rendered.count("<|im_start|>assistant\n") == len(said)


def test_every_participant_gets_the_whole_dialogue(spark):
    found = chat_format.rotate_perspectives(frame(spark)).collect()
    assert {(row.conv_id, row.perspective) for row in found} == {
        (1, "ann"), (1, "bob"), (1, "cy"), (3, "ann"), (3, "bob"), (None, "ann"), (4, "assistant"), (4, "user")}
    assert all(sum(row.n_turns for row in found if (row.conv_id, row.perspective) == key) == sum(1 for turn in ROWS if turn[0] == key[0])
               for key in {(row.conv_id, row.perspective) for row in found})


def test_a_crowded_part_is_cut_without_losing_turns(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PART_ROWS", 10)
    rows = [(1, 7, "ann" if n % 2 else "bob", f"text {n}") for n in range(100)]
    found = chat_format.rotate_perspectives(frame(spark, rows)).collect()
    assert len({row.piece for row in found}) > 5 and max(row.n_turns for row in found) < 40
    assert sum(row.n_turns for row in found if row.perspective == "ann") == 100


def test_empty_table(spark):
    assert chat_format.rotate_perspectives(frame(spark, [])).count() == 0


CROWD = [(1, n % 3 + 6 if n % 10 else None, (None, "ann", "bob", "system")[n % 4], f"text {n * 37 % 400}") for n in range(400)]
CROWD += [(None, None, "cy", f"alone {n}") for n in range(50)] + ROWS
REPEATS = [(1, 7, "ann", "again")] * 60 + [(1, n % 2 + 7, "bob", f"text {n % 9}") for n in range(50)]


def test_a_crowded_part_is_one_dialogue_as_in_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chat_format, "PART_ROWS", 10)
    turns = frame(spark, CROWD)
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    same_as_sql(QUERIES["op8_chat_format"](spark, str(tmp_path)), tables({"conversations": turns}), ORACLES["op8_chat_format"])


def test_the_size_of_a_part_changes_no_result(spark, tmp_path, monkeypatch):
    frame(spark, CROWD + REPEATS).write.parquet(str(tmp_path / "conversations.parquet"))
    found = lambda: sorted(map(repr, QUERIES["op8_chat_format"](spark, str(tmp_path)).collect()))
    whole = found()
    monkeypatch.setattr(chat_format, "PART_ROWS", 10)
    assert found() == whole


def test_pieces_in_their_order_are_the_dialogue(spark, monkeypatch):
    rows = [(1, 7, "ann" if n % 2 else "bob", f"text {n}") for n in range(100)]
    whole = {row.perspective: row.rendered for row in chat_format.rotate_perspectives(frame(spark, rows)).collect()}
    monkeypatch.setattr(chat_format, "PART_ROWS", 10)
    found = sorted(chat_format.rotate_perspectives(frame(spark, rows)).collect(), key=lambda row: row.piece)
    assert {name: "".join(row.rendered for row in found if row.perspective == name) for name in whole} == whole
    assert max(row.n_turns for row in found) <= 10


LENGTHY = [(1, n, ("ann", "bob", "cy")[n % 3], f"text {n}") for n in range(200)]
SPARSE = [(2, n * 100, ("ann", "bob")[n % 2], f"text {n}") for n in range(200)] + [(2, None, "ann", "late"), (5, 9000, "dan", "alone"), (5, 1, None, "?")]


def test_a_dialogue_of_200_turns_is_one_row_a_participant(spark, tmp_path):
    turns = frame(spark, LENGTHY)
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    found = QUERIES["op8_chat_format"](spark, str(tmp_path))
    assert sorted((row.perspective, row.n_turns) for row in found.collect()) == [("ann", 200), ("bob", 200), ("cy", 200)]
    same_as_sql(found, tables({"conversations": turns}), ORACLES["op8_chat_format"])


def test_both_ways_agree_with_sql_beyond_a_part(spark, tmp_path, monkeypatch):
    turns = frame(spark, LENGTHY + SPARSE + CROWD[:30])
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    for rows, sent in ((4096, 100), (10, 100), (10, 0)):
        monkeypatch.setattr(chat_format, "PART_ROWS", rows)
        monkeypatch.setattr(chat_format, "SENT_KEYS", sent)
        same_as_sql(QUERIES["op8_chat_format"](spark, str(tmp_path)), tables({"conversations": turns}), ORACLES["op8_chat_format"])
