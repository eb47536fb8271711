"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time ``t`` in [0, 1]: a straight line through
its weight with a relative slope (``ramp``). The integral of a schedule is the source's
weight, so the targets follow from the weights alone; the slope says when the words are used.
With ``r`` the ramp and ``T`` the target, a source has used ``T * ((1 - r) t + r t^2)`` words by
time ``t``. Inverting that for the word at which a document starts gives the time at which the
document is due, and the sum over all sources gives its position in the mix, in words.

Everything is a DataFrame expression. A source is never gathered in one place: its documents
are put in a fixed random order (MD5 of the id), the order is cut into 4,096 slices, slices
are summed, and only a slice (a 4,096th of a source) is ordered inside a task.

Defined results
    null text: size 0. Null source: a source of its own, ranked last. Null id: ordered as the
    empty string. Repeated rows: each is a document of its own. Sources without words: target 0,
    nothing taken. Empty table: no rows. Columns other than the named ones are ignored by
    ``plan_mix`` and kept by ``mixed_documents``, whatever their names.
"""

from pyspark.sql import Window, functions as F

from microtally.llm.registry import query, read
from microtally.llm.text import WORD, whole, word_count
from microtally.session import checkpointed

# Weights and ramps by the rank of a source, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
RAMPS = (0.6, 0.0, -0.6)
SHARE = 1.5
MAX_PASSES = 2

SLICE_DIGITS = 3


def _cyclic(values, rank):
    """The value for a rank, starting over after the last one."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(sources, weights=WEIGHTS, ramps=RAMPS, share=SHARE, max_passes=MAX_PASSES):
    """Targets of ``(source, source_size)`` rows, one per source.

    ``share`` times all words are shared by weight; a source stops at ``max_passes`` times its
    size and the rest is shared again. The common level of words per unit of weight is found
    in one pass over the sources in the order in which they fill up. A source is a row here,
    so the windows see as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("fills_at", "rank")
    before, rest = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.col("source_size") * F.lit(float(max_passes))
    ranked = (
        sources.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", _cyclic(weights, F.col("rank")))
        .withColumn("ramp", _cyclic(ramps, F.col("rank")))
        .withColumn("words", F.sum("source_size").over(everything))
        .withColumn("fills_at", cap / F.col("weight"))
        .withColumn("level", (F.col("words") * F.lit(float(share)) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
                    / F.sum("weight").over(rest))
        .withColumn("full", cap <= F.col("level") * F.col("weight"))
    )
    open_level = F.min(F.when(~F.col("full"), F.struct("fills_at", "rank", "level"))).over(everything)["level"]
    target = F.when(F.col("full"), cap).otherwise(F.col("open_level") * F.col("weight"))
    return (
        ranked.withColumn("open_level", open_level).withColumn("target", target)
        .withColumn("steady", F.sum(F.col("target") * (1 - F.col("ramp"))).over(everything))
        .withColumn("rising", F.sum(F.col("target") * F.col("ramp")).over(everything))
        .select("source", "source_size", "weight", "ramp", "target", "steady", "rising")
    )


def _named(source):
    """A key for a source that is never null and the same for no two sources."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source))


def _position(start):
    """Position in the mix of the word at which a source has used ``start`` words."""
    used, ramp = start / F.col("target"), F.col("ramp")
    root = F.sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * used)
    time = F.when(ramp == 0, used).otherwise((root - (1 - ramp)) / (2 * ramp))
    return F.col("steady") * time + F.col("rising") * time * time


def plan_mix(docs, id="doc_id", text="text", source="source", **settings):
    """What the mix takes of each document.

    Returns one row per row of ``docs``: ``doc_id, size, source, source_size, target, taken`` and
    ``passes``, an array with one ``(words, position)`` per time the document is used; ``words`` is
    less than ``size`` only for the document at which a source's target is reached.
    """
    name = F.col(source).cast("string")
    narrow = checkpointed(docs.select(
        F.col(id).alias("doc_id"), name.alias("source"), word_count(F.col(text)).alias("size"), _named(name).alias("bin"),
        F.md5(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")).alias("key"),
    ).withColumn("slice", F.substring("key", 1, SLICE_DIGITS)))

    slices = narrow.groupBy("bin", "slice").agg(F.first("source").alias("source"), F.sum("size").alias("slice_size"))
    sources = slices.groupBy("bin").agg(F.first("source").alias("source"), F.sum("slice_size").alias("source_size"))
    targets = source_targets(sources.drop("bin"), **settings).withColumn("bin", _named(F.col("source"))).drop("source")
    earlier = Window.partitionBy("bin").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("bin", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).cast("long").alias("slice_start"))

    inside = Window.partitionBy("bin", "slice").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        narrow.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)).cast("long"))
        .join(slices.join(targets, "bin"), ["bin", "slice"])
        .withColumn("start", F.col("start") + F.col("slice_start"))
        .withColumn("quota", F.floor("target").cast("long"))
    )
    size, start = F.col("size"), F.col("start")
    most = int(settings.get("max_passes", MAX_PASSES))
    passes = []
    for number in range(most):
        words = F.greatest(F.lit(0), F.least(size, F.col("quota") - number * F.col("source_size") - start)).cast("long")
        used = F.struct(words.alias("words"), _position(start + number * F.col("source_size")).alias("position"))
        passes.append(F.when(words > 0, used))
    return placed.withColumn("passes", F.array_compact(F.array(*passes))).select(
        "doc_id", "size", "source", "source_size", "target",
        F.aggregate("passes", F.lit(0).cast("long"), lambda total, item: total + item["words"]).alias("taken"),
        "passes", "key",
    )


def mixed_documents(docs, id="doc_id", text="text", source="source", **settings):
    """The training order itself: rows of ``docs``, once per time they are used, sorted by position.

    The columns are those of ``docs``, and every text is whole: the document at which a source reaches its
    target is used to its end, so a source is above its target by less than one document. Rows
    without words are never used. Rows that share an id, a source and a size are paired off with their plans in
    any order; only copies of a row, or rows without an id, can be swapped by that.

    A text moves once to meet its plan and once to its place in the order. Rows are numbered, which moves them
    again, only where several share id, source and size.
    """
    same = ["mix_key", "mix_bin", "mix_size"]
    number = F.row_number().over(Window.partitionBy(*same).orderBy("mix_order"))
    plan = plan_mix(docs, id, text, source, **settings).filter("taken > 0").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("mix_key"), _named(F.col("source")).alias("mix_bin"),
        F.col("size").alias("mix_size"), F.col("taken").alias("mix_order"), F.col("passes").alias("mix_passes"),
    ).withColumn("mix_number", number).withColumn("mix_rows", F.count("*").over(Window.partitionBy(*same)))
    plan = checkpointed(plan.drop("mix_order"))
    keyed = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("mix_row"),
        F.coalesce(F.col(id).cast("string"), F.lit("")).alias("mix_key"), _named(F.col(source).cast("string")).alias("mix_bin"),
        word_count(F.col(text)).alias("mix_size"),
    ).filter("mix_size > 0")
    alone = keyed.join(plan.filter("mix_rows = 1"), same)
    several = plan.filter("mix_rows > 1")
    numbered = keyed.join(several.select(same).distinct(), same, "left_semi").withColumn("mix_order", F.lit(0)).withColumn("mix_number", number)
    together = numbered.join(several, [*same, "mix_number"])
    used = alone.select("mix_row", "mix_key", "mix_passes").unionByName(together.select("mix_row", "mix_key", "mix_passes"))
    used = used.select("mix_row", "mix_key", F.explode("mix_passes").alias("mix_pass")).orderBy(F.col("mix_pass.position"), F.col("mix_key"))
    return used.select(*[F.col("mix_row")[name].alias(name) for name in docs.columns])


OP1_SQL = """
WITH sizes AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS mix_key,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
    FROM documents
), per_source AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sizes GROUP BY source
), weighted AS (
    SELECT *, CAST([5, 2, 1][(place - 1) % 3 + 1] AS DOUBLE) AS weight,
           source_size * CAST(2 AS DOUBLE) AS ceiling_words FROM per_source
), levels AS (
    SELECT *, ((SELECT sum(source_size) FROM per_source) * CAST(1.5 AS DOUBLE)
               - coalesce(sum(ceiling_words) OVER (ORDER BY ceiling_words / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY ceiling_words / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted
), chosen AS (
    SELECT arg_min(level, ceiling_words / weight) AS open_level FROM levels WHERE ceiling_words > level * weight
), targets AS (
    SELECT source, source_size,
           CASE WHEN ceiling_words <= level * weight THEN ceiling_words ELSE open_level * weight END AS target,
           CAST([0.6, 0.0, -0.6][(place - 1) % 3 + 1] AS DOUBLE) AS ramp
    FROM levels LEFT JOIN chosen ON true
), curriculum AS (
    SELECT sum(target * (1 - ramp)) AS steady, sum(target * ramp) AS rising FROM targets
), starts AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY mix_key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin_word
    FROM sizes
)
SELECT doc_id, size, source_size, target, taken,
       -- the time by which a source has used the words before this document, and all words used by then
       CASE WHEN taken > 0 THEN CAST(round(steady * due + rising * due * due) AS BIGINT) END AS position
FROM (
    SELECT *, CASE WHEN ramp = 0 THEN begin_word / target
                   ELSE (sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * begin_word / target) - (1 - ramp)) / (2 * ramp) END AS due
    FROM (
        SELECT s.doc_id, s.size, t.source_size, t.target, t.ramp, c.steady, c.rising, s.begin_word,
               CAST(greatest(0, least(s.size, floor(t.target) - s.begin_word))
                  + greatest(0, least(s.size, floor(t.target) - t.source_size - s.begin_word)) AS BIGINT) AS taken
        FROM starts s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source CROSS JOIN curriculum c))
"""


@query("op1_mix_sources", OP1_SQL)
def op1_mix_sources(spark, sf_dir):
    """All documents with what the mix takes of them, in the order of their first use.

    ``position`` is the word of the mix at which a document is first used, null if it never is.
    """
    plan = plan_mix(read(spark, sf_dir, "documents"))
    due = F.get("passes", F.lit(0))["position"]
    return plan.orderBy(due.asc_nulls_last(), F.col("key")).select(
        "doc_id", "size", "source_size", "target", "taken", F.round(due).cast("long").alias("position"))
