"""Chat formatting by perspective rotation, in DataFrame expressions only.

Every participant of a conversation gets the dialogue from their own view: their turns are those of
the assistant, everybody else is a named user, system turns stay what they are. The mask says
which characters a model may learn from: the texts of the participant's own turns with their end
mark.

A rendered dialogue is a row, with the turns in order, as long as its turn numbers stay within 4,096;
beyond that a dialogue is a row per part of 4,096 turn numbers, and its parts in order are the dialogue.
A conversation of few rows is brought together once, which gives its turns and its participants. Only
conversations of many rows take a longer way, so that none has to fit into one task: their parts meet
their participants by a join, and a part in which turn numbers are used again and again is sorted by
ranges and rendered in pieces of neighbouring turns. The query puts the pieces of a part together, so a
part is one row at every size; a cell of Spark holds 2 GB at most. Both ways give the same rows.

Defined results
    null text: an empty turn. Null role: a user named ``unknown``, who gets no perspective. Null turn: after
    all others, in a part of its own. Null conversation: one conversation. Equal turn numbers: ordered
    by role and text. Repeated rows: rendered as often as they occur. A conversation of system
    turns only has no perspective. Empty table: no rows. End marks inside a text lose their power: a
    blank is put into them. Other columns are ignored.
"""

from pyspark.sql import Window, functions as F

from microtally.llm.registry import query, read
from microtally.session import checkpointed

# The marks of the chat format, and the role that is no participant.
START, END, SYSTEM, NOBODY = "<|im_start|>", "<|im_end|>", "system", "unknown"

# Turn numbers in a part; rows up to which a conversation, or a part of a longer one, is one group.
PART_TURNS = 4096
PART_ROWS = 4096
# Conversations of many rows whose ids are sent to all tasks; if there are more, they are joined.
SENT_KEYS = 100_000


def _segment(turn, perspective):
    """A turn as it is written from a perspective: what precedes its text, and the rest."""
    own, system = turn["role"] == perspective, turn["role"] == SYSTEM
    name = F.when(own, F.lit("assistant")).when(system, F.lit("system")).otherwise(F.concat(F.lit("user name="), turn["role"]))
    return F.concat(F.lit(START), name, F.lit("\n")), F.concat(turn["text"], F.lit(END))


def _rendered(turns, perspective):
    def written(turn):
        head, rest = _segment(turn, perspective)
        return F.concat(head, rest, F.lit("\n"))

    return F.array_join(F.transform(turns, written), "")


def _spans(turns, perspective):
    """Start and end, in characters, of what the perspective's own turns say."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(done, turn):
        head, rest = _segment(turn, perspective)
        start = done["at"] + F.length(head)
        end = start + F.length(rest)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(turn["role"] == perspective, F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(turns, empty, add)["spans"]


def _part(turn):
    return F.floor(turn / PART_TURNS).cast("long")


def _turns(turns, conversation, turn, role, text):
    """Turns with their part, in a struct that sorts as the dialogue."""
    return turns.select(
        F.col(conversation).alias("conv_id"), _part(F.col(turn)).alias("part"),
        F.struct(
            F.col(turn).isNull().alias("late"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(NOBODY)).alias("role"),
            F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|im_"), F.lit("<| im_")).alias("text")).alias("said"),
        (F.col(role).isNotNull() & (F.col(role) != SYSTEM)).alias("takes_part"))


def _of_few_rows(said):
    """Rendered parts of conversations that are one group each."""
    groups = said.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("said", "takes_part"))).alias("all"))
    speakers = F.transform(F.filter("all", lambda each: each["takes_part"]), lambda each: each["said"]["role"])
    groups = groups.select(
        "conv_id", F.array_distinct(speakers).alias("speakers"), F.transform("all", lambda each: each["said"]).alias("said"))
    parts = F.array_distinct(F.transform("said", lambda each: _part(each["turn"])))
    cells = groups.select("conv_id", "said", "speakers", F.explode(parts).alias("part"))
    cells = cells.select("conv_id", "speakers", "part", F.filter("said", lambda each: _part(each["turn"]).eqNullSafe(F.col("part"))).alias("turns"))
    cells = cells.select("conv_id", "part", "turns", F.explode("speakers").alias("perspective"))
    return cells.select("conv_id", "perspective", "part", F.lit(0).cast("long").alias("piece"), *_written())


def _written():
    turns, perspective = F.col("turns"), F.col("perspective")
    return F.size(turns).cast("long").alias("n_turns"), _rendered(turns, perspective).alias("rendered"), _spans(turns, perspective).alias("spans")


def _views(said):
    """Two frames of rendered turns: of whole parts, and of the pieces of crowded parts."""
    long = checkpointed(said.groupBy("conv_id").count().filter(F.col("count") > PART_ROWS).select(F.col("conv_id").alias("k")))
    long = F.broadcast(long) if long.limit(SENT_KEYS + 1).count() <= SENT_KEYS else long
    known = F.col("conv_id").eqNullSafe(F.col("k"))
    parts, pieces = _of_many_rows(said.join(long, known, "left_semi"))
    return _of_few_rows(said.join(long, known, "left_anti")).unionByName(parts), pieces


def _of_many_rows(said):
    """Rendered parts, and pieces of crowded parts, of conversations that may be of any size."""
    crowded = said.groupBy("conv_id", "part").count().filter(F.col("count") > PART_ROWS)
    crowded = crowded.select(F.col("conv_id").alias("c"), F.col("part").alias("p"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("part").eqNullSafe(F.col("p"))
    views = said.filter("takes_part").select(F.col("conv_id").alias("c"), F.col("said.role").alias("perspective")).distinct()

    def seen(dealt):
        parts = dealt.groupBy("conv_id", "part", "piece").agg(F.array_sort(F.collect_list("said")).alias("turns"))
        return parts.join(views, F.col("conv_id").eqNullSafe(F.col("c"))).select(
            "conv_id", "perspective", "part", "piece", *_written())

    few = said.join(crowded, same, "left_anti").withColumn("piece", F.lit(0).cast("long"))
    # Ids grow with the place in the sorted ranges, so a run of them is a run of turns.
    many = said.join(crowded, same, "left_semi").repartitionByRange("conv_id", "part", "said").sortWithinPartitions("conv_id", "part", "said")
    many = many.withColumn("piece", F.floor(F.monotonically_increasing_id() / PART_ROWS).cast("long"))
    return seen(few), seen(many)


def rotate_perspectives(turns, conversation="conv_id", turn="turn", role="role", text="text"):
    """``conv_id, perspective, part, piece, n_turns, rendered, spans`` for every participant and part of each conversation.

    ``part`` is the turn number divided by 4,096, ``piece`` is 0 unless a part had to be cut further. The
    pieces of a part, in the order of their numbers, are its dialogue; spans count from the piece's start.
    """
    whole, pieces = _views(_turns(turns, conversation, turn, role, text))
    return whole.unionByName(pieces)


def _mask(spans, before):
    """Spans as text, moved by the characters before them; null if there are none."""
    moved = F.transform(spans, lambda span: F.concat_ws("-", before + span["start"], before + span["end"]))
    return F.when(F.size(spans) > 0, F.array_join(moved, ","))


def whole_dialogues(turns, **columns):
    """``conv_id, perspective, part, n_turns, rendered, mask``: one row per participant and part, whatever its size."""
    names = {"conversation": "conv_id", "turn": "turn", "role": "role", "text": "text"}
    whole, pieces = _views(_turns(turns, **{**names, **columns}))
    key = ["conv_id", "perspective", "part"]
    whole = whole.select(*key, "n_turns", "rendered", _mask(F.col("spans"), F.lit(0).cast("long")).alias("mask"))
    earlier = Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("rendered").cast("long")).over(earlier), F.lit(0).cast("long"))
    placed = pieces.withColumn("before", before).select(
        *key, "n_turns", F.struct("piece", "rendered", _mask(F.col("spans"), F.col("before")).alias("mask")).alias("one"))
    joined = placed.groupBy(*key).agg(
        F.sum("n_turns").alias("n_turns"), F.array_sort(F.collect_list("one")).alias("all"), F.count("one.mask").alias("masks"))
    joined = joined.select(
        *key, "n_turns", F.array_join("all.rendered", "").alias("rendered"),
        F.when(F.col("masks") > 0, F.array_join("all.mask", ",")).alias("mask"))
    return whole.unionByName(joined)


OP8_SQL = """
WITH views AS (
    SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'
), written AS (
    SELECT c.conv_id, v.perspective, CAST(floor(c.turn / 4096) AS BIGINT) AS part, c.turn, coalesce(c.role, 'unknown') AS speaker,
           replace(coalesce(c.text, ''), '<|im_', '<| im_') AS body
    FROM conversations c JOIN views v ON c.conv_id IS NOT DISTINCT FROM v.conv_id
), segments AS (
    SELECT *, '<|im_start|>' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
                                     ELSE 'user name=' || speaker END || chr(10) AS head, body || '<|im_end|>' AS rest
    FROM written
), placed AS (
    SELECT *, coalesce(sum(length(head) + length(rest) + 1) OVER (
        PARTITION BY conv_id, perspective, part ORDER BY turn NULLS LAST, speaker, body
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begins
    FROM segments
)
SELECT conv_id, perspective, part, count(*) AS n_turns,
       string_agg(head || rest || chr(10), '' ORDER BY turn NULLS LAST, speaker, body) AS rendered,
       string_agg(CAST(CAST(begins AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(begins + length(rest) AS BIGINT) AS VARCHAR), ',' ORDER BY turn NULLS LAST, speaker, body)
           FILTER (WHERE speaker = perspective) AS mask
FROM placed GROUP BY conv_id, perspective, part
"""


@query("op8_chat_format", OP8_SQL)
def op8_chat_format(spark, sf_dir):
    """All conversations from the view of each participant, with the spans to learn from."""
    return whole_dialogues(read(spark, sf_dir, "conversations"))
