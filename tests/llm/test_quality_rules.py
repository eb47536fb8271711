from microtally.llm import operators, quality_rules  # noqa: F401
from microtally.llm.registry import ORACLES, QUERIES
from tests.llm.cases import PROSE, SF_DIR, awkward, clashing, same_as_sql, tables
from workload.check import compare, connect


def repeated_words(text):
    """Words in five-word windows that are found twice or more."""
    words = (text or "").replace("\x0b", " ").replace("\x0c", " ").split()
    seen, covered = {}, set()
    for place in range(len(words) - 4):
        seen.setdefault(tuple(words[place:place + 5]), []).append(place)
    for places in seen.values():
        if len(places) > 1:
            for place in places:
                covered |= set(range(place, place + 5))
    return len(covered)


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF_DIR), QUERIES["op4_quality_rules"], ORACLES["op4_quality_rules"], SF_DIR) is None


def test_awkward_rows_agree_with_sql(spark, tmp_path):
    docs = awkward(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op4_quality_rules"](spark, str(tmp_path))
    same_as_sql(found, tables({"documents": docs}), ORACLES["op4_quality_rules"])


def test_windows_that_overlap_share_their_words(spark):
    texts = ["a b c d e f g", "a b c d e a b c d e", "a a a a a a a", "a b c d e x a b c d e y", "a b c d", "a b c d e f a b c d e f a", PROSE + " " + PROSE]
    docs = awkward(spark, [(n, text, None, None, None) for n, text in enumerate(texts)])
    found = quality_rules.quality_cascade(docs, facts=["n_repeat_words"], order=quality_rules.RULES)
    got = {row.doc_id: row.quality.n_repeat_words for row in found.collect()}
    assert got == {n: repeated_words(text) for n, text in enumerate(texts)}


def test_the_order_of_rules_changes_no_verdict(spark):
    docs = clashing(awkward(spark))
    one = quality_rules.quality_cascade(docs, order=quality_rules.RULES, into="v")
    other = quality_rules.quality_cascade(docs, order=quality_rules.RULES[::-1], into="v")
    assert one.columns == [*docs.columns, "v"]
    verdicts = [sorted(repr((row.doc_id, row.text, row.v.kept)) for row in frame.collect()) for frame in (one, other)]
    assert verdicts[0] == verdicts[1]


def test_rules_are_ordered_by_rejection_per_cost(spark):
    order = quality_rules.rule_order(awkward(spark))
    gains = [share / cost for _, share, cost in order]
    assert gains == sorted(gains, reverse=True) and {rule.name for rule, _, _ in order} == {rule.name for rule in quality_rules.RULES}


def test_empty_table(spark):
    docs = awkward(spark, [])
    assert quality_rules.quality_cascade(docs, into="v").columns == [*docs.columns, "v"]
    assert quality_rules.quality_cascade(docs).count() == 0


def test_facts_are_computed_for_the_living_only(spark):
    plan = quality_rules.quality_cascade(awkward(spark), order=quality_rules.RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "CASE WHEN isnull(q$by" in plan


def test_a_filter_on_the_verdict_stays_above_the_steps(spark):
    judged = quality_rules.quality_cascade(awkward(spark), into="v").filter("v.kept")
    assert len(judged._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    assert {row.doc_id for row in judged.collect()} == {1, 2, None, 10}
