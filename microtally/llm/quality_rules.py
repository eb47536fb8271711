"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

A rule looks at a few facts of a document and says whether it rejects it. On a sample the cascade
measures what each rule costs and how much it rejects, and puts the rules in the order of
rejection per cost. Every document then meets the rules in that order; once a rule has rejected
it, no further fact is computed for it: each fact stands in a CASE on the verdict so far. The
order changes the cost, never the verdict.

Defined results
    null and empty texts: no words, rejected by ``few_words``. Repeated rows: judged one by one.
    Empty table: no rows. The columns of the table are kept as they are, whatever their names; what
    the cascade adds is held in one struct column whose name the caller may choose.
"""

import time
from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import functions as F

from microtally.llm.registry import query, read
from microtally.llm.text import whole, words
from microtally.session import checkpointed

# Size of a window of words, and the characters that count as symbols.
WINDOW = 5
SYMBOLS = "#*$%&|<>"

# Rows on which the order of the rules is estimated. They decide the order only, no verdict.
SAMPLE_ROWS = 400


def _long(column):
    return column.cast("long")


def _lines(text):
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def _repeated_places(hashes):
    """Places of the windows that are found twice or more, in order."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def among(pairs):
        twice = F.filter(pairs, lambda pair, i: (
            F.coalesce(F.get(pairs, i - 1)["h"] == pair["h"], F.lit(False))
            | F.coalesce(F.get(pairs, i + 1)["h"] == pair["h"], F.lit(False))))
        return F.array_sort(F.transform(twice, lambda pair: pair["i"]))

    return F.get(F.transform(F.array(pairs), among), F.lit(0))


def _covered(places):
    """Words in the windows that start at ``places``: overlapping windows share their words."""
    gaps = F.transform(places, lambda place, i: F.coalesce(F.least(F.lit(WINDOW), place - F.get(places, i - 1)), F.lit(WINDOW)))
    return _long(F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap))


def _window_hashes(word_hashes):
    last = F.size(word_hashes) - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(word_hashes, i + k) for k in range(WINDOW)]))


# What can be known of a document: how it is computed from the text and the facts it needs. Facts
# named with an underscore are steps on the way.
FACTS: dict[str, tuple[tuple, Callable]] = {
    "_words": ((), lambda text: words(text)),
    "n_words": (("_words",), lambda text, w: _long(F.size(w))),
    "word_chars": (("_words",), lambda text, w: _long(F.length(F.array_join(w, "")))),
    "n_symbols": ((), lambda text: _long(F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")))),
    "n_capitals": ((), lambda text: _long(F.length(F.regexp_replace(text, "[^A-Z]+", "")))),
    "_lines": ((), lambda text: _lines(text)),
    "n_lines": (("_lines",), lambda text, lines: _long(F.size(lines))),
    "n_dup_lines": (("_lines",), lambda text, lines: _long(F.size(lines) - F.size(F.array_distinct(lines)))),
    "_word_hashes": (("_words",), lambda text, w: F.transform(w, lambda word: F.xxhash64(word))),
    "_windows": (("_word_hashes",), lambda text, hashes: _window_hashes(hashes)),
    "_places": (("_windows",), lambda text, windows: F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), _repeated_places(windows))),
    "n_repeat_words": (("_places",), lambda text, places: F.coalesce(_covered(places), F.lit(0).cast("long"))),
}


@dataclass(frozen=True)
class Rule:
    """A rule by its name, the facts it looks at and the condition on which it rejects."""

    name: str
    facts: tuple
    rejects: Callable
    base: bool = False


# Thresholds are far from what prose shows: prose has next to no symbols, words of three to nine
# characters, few capitals and few lines said twice.
RULES = (
    Rule("few_words", ("n_words",), lambda f: f("n_words") < 10, True),
    Rule("repeated_windows", ("n_repeat_words", "n_words"), lambda f: 100 * f("n_repeat_words") > 20 * f("n_words"), True),
    Rule("symbols", ("n_symbols", "n_words"), lambda f: 4 * f("n_symbols") > f("n_words")),
    Rule("word_length", ("word_chars", "n_words"),
         lambda f: (f("word_chars") < 2 * f("n_words")) | (f("word_chars") > 15 * f("n_words"))),
    Rule("capitals", ("n_capitals", "word_chars"), lambda f: 100 * f("n_capitals") > 40 * f("word_chars")),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda f: 100 * f("n_dup_lines") > 60 * f("n_lines")),
)


def _needed(names, have=()):
    """The facts to compute for ``names``, each after those it needs."""
    order = []
    for name in names:
        if name not in have and name not in order:
            order += [step for step in _needed(FACTS[name][0], (*have, *order)) if step not in order]
            order.append(name)
    return order


def _with_facts(df, text, names, alive=None):
    """Adds facts as columns ``q$<name>``, for the rows that are still alive only."""
    for name in names:
        needs, compute = FACTS[name]
        value = compute(text, *[F.col(f"q${need}") for need in needs])
        df = df.withColumn(f"q${name}", value if alive is None else F.when(alive, value))
    return df


def _fact(name):
    return F.col(f"q${name}")


def _seconds(df):
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def rule_order(docs, text="text", rules=RULES, sample_rows=SAMPLE_ROWS):
    """The rules in the order of rejection per cost, with both figures.

    A rule's cost is the time of its facts over the sample, less the time of reading it; the first
    run of each is not counted. A rule that rejects nothing comes last, the cheaper the earlier.
    """
    sample = checkpointed(docs.select(whole(F.col(text)).alias("text")).limit(sample_rows))
    rows = max(sample.count(), 1)
    measured = []
    frames = {rule.name: _with_facts(sample, F.col("text"), _needed(rule.facts)).select(rule.rejects(_fact).alias("hit")) for rule in rules}
    hits = [F.sum(rule.rejects(_fact).cast("long")).alias(rule.name) for rule in rules]
    everything = _with_facts(sample, F.col("text"), _needed([name for rule in rules for name in rule.facts]))
    found = everything.agg(*hits).first()
    idle = min(_seconds(sample) for _ in range(2))
    for rule in rules:
        cost = max(min(_seconds(frames[rule.name]) for _ in range(2)) - idle, 1e-4)
        measured.append((rule, (found[rule.name] or 0) / rows, cost / rows))
    return sorted(measured, key=lambda item: (-item[1] / item[2], item[2]))


def quality_cascade(docs, text="text", rules=RULES, order=None, facts=(), into="quality"):
    """The rows of ``docs`` with a struct ``into``: ``kept``, ``rejected_by`` and the asked facts.

    ``rejected_by`` is the first rule in the order of the cascade that rejects the document. Facts
    named in ``facts`` are computed for all rows, so what they need is no longer saved.
    """
    rules = order if order is not None else [rule for rule, _, _ in rule_order(docs, text, rules)]
    df = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("q$row"))
    df = df.withColumn("q$text", whole(F.col("q$row")[text]))
    have = _needed(facts)
    df = _with_facts(df, F.col("q$text"), have)
    df = df.withColumn("q$by", F.lit(None).cast("string"))
    for rule in rules:
        alive = F.col("q$by").isNull()
        steps = _needed(rule.facts, have)
        df = _with_facts(df, F.col("q$text"), steps, alive)
        have = [*have, *steps]
        df = df.withColumn("q$by", F.when(alive & rule.rejects(_fact), F.lit(rule.name)).otherwise(F.col("q$by")))
    # A condition that is always true but not a function of the row: without it a filter on the
    # verdict would be pushed below all steps, and every step written out again in each later one.
    settled = F.monotonically_increasing_id() >= 0
    verdict = F.struct((F.col("q$by").isNull() & settled).alias("kept"), F.col("q$by").alias("rejected_by"), *[_fact(name).alias(name) for name in facts])
    own = [F.col("q$row")[name].alias(name) for name in docs.columns]
    return df.select(*own, verdict.alias(into))


OP4_FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

OP4_SQL = """
WITH base AS (
    SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS word_list,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS line_list
    FROM documents
), windows AS (
    SELECT row_id, place, list_slice(word_list, place, place + 4) AS five
    FROM (SELECT row_id, word_list, unnest(range(1, len(word_list) - 3)) AS place FROM base)
), repeated AS (
    SELECT row_id, place FROM windows
    QUALIFY count(*) OVER (PARTITION BY row_id, five) > 1
), covered AS (
    SELECT row_id, count(DISTINCT word_place) AS n_repeat_words
    FROM (SELECT row_id, unnest(range(place, place + 5)) AS word_place FROM repeated) GROUP BY row_id
), facts AS (
    SELECT b.doc_id, CAST(len(word_list) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(body, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(line_list) - len(list_distinct(line_list)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           length(regexp_replace(body, '[^A-Z]+', '', 'g')) AS n_capitals, len(line_list) AS n_lines
    FROM base b LEFT JOIN covered c USING (row_id)
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM facts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 4 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_capitals > 40 * word_chars OR 100 * n_dup_lines > 60 * n_lines) AS kept
FROM judged
"""


@query("op4_quality_rules", OP4_SQL)
def op4_quality_rules(spark, sf_dir):
    """All documents with the facts of the base rules and the verdict of the cascade."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_cascade(docs, facts=OP4_FACTS)
    fact = lambda name: F.col(f"quality.{name}")
    failed = (fact("n_words") < 10) | (100 * fact("n_repeat_words") > 20 * fact("n_words"))
    return judged.select("doc_id", *[fact(name).alias(name) for name in OP4_FACTS],
                         failed.alias("base_failed"), fact("kept").alias("kept"))
