"""Multi-party perspective rotation of dialogues.

Every participant of a conversation (each speaker but ``system``) gets the
dialogue rendered with its own turns as the assistant and all other speakers
as named users; the mask marks exactly the characters the assistant writes,
its end marker included.  System turns are the frame of every rendering.

Only DataFrame functions.  A rendering is cut into parts of ``PART`` turn
numbers, and what a turn number holds beyond its share of ``ROWS`` (rows
without a turn number: beyond ``ROWS``) becomes pieces of its own, dealt by
hash for about half of ``ROWS`` each, so no part gathers more than ``ROWS``
turns however often a turn number is there.  Such turns are counted with
map-side combining; there is at most one of them to ``ROWS / PART`` rows.  Piece k of part p has the number
p + k * 2^42: a part's first rows keep p (turn numbers below 2^47).  The SQL
has the same rule.  The two lists of such turns are broadcast only where their
counted rows are few (``common.small``) and shuffled beyond that.  Speakers are
found with map-side combining and come to the turns by a join that skewed-join
handling may split.

Defined results: null texts are empty, null roles are the speaker
``unknown``; a turn that is there twice with the same role and text is one
turn; different rows of one turn number follow by role and text; rows without
a turn number have no order and form parts of their own by the hash of their
text; a null conv_id is a conversation of its own; a conversation with system
turns only has no participant and no rendering; markers inside a text are
broken up; rows of one turn number that is in pieces have an order within a
piece only; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, prepare, small, table
from .registry import register

PART = 64
#: Parts for rows without a turn number.
LOOSE = 1024
#: Rows that a part gathers at most, and the distance of a part's pieces.
ROWS, PIECE = 16_384, 1 << 42
START, END = "<|im_start|>", "<|im_end|>\n"


def _head(role: Column, speaker: Column) -> Column:
    who = (F.when(role == "system", F.lit("system")).when(role == speaker, F.lit("assistant"))
           .otherwise(F.concat(F.lit("user name="), role)))
    return F.concat(F.lit(START), who, F.lit("\n"))


def _dealt(x: Column) -> Column:
    """A number below 2^32 that ``x`` decides."""
    return F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")


def _parts(turns: DataFrame, part: int) -> DataFrame:
    """Different (conv_id, turn, role, text), cleaned, with ``part``."""
    clean = F.regexp_replace(F.coalesce("text", F.lit("")), r"<\|", "< |")
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                     F.coalesce("role", F.lit("unknown")).alias("role"), clean.alias("text")).dropDuplicates()
    loose = -1 - F.pmod(_dealt(F.col("text")), F.lit(LOOSE))
    return t.withColumn("part", F.coalesce(F.floor(F.col("turn") / part), loose).cast("long"))


def _in_pieces(t: DataFrame, turns: DataFrame, part: int, rows: int) -> DataFrame:
    """``t`` = ``_parts(turns)``, the parts of turns with too many rows cut into pieces."""
    share = max(rows // part, 1)
    # turns with that many rows, copies included: found without reading texts, on any usual input none
    many = (turns.groupBy("conv_id", F.col("turn").cast("long").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > share).select(F.col("conv_id").alias("_c"), "_t"))
    many = small(cut(many))
    some = turns.join(many, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").cast("long").eqNullSafe(F.col("_t")),
                      "left_semi")
    over = (_parts(some, part).groupBy("conv_id", "part", "turn").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > F.when(F.col("turn").isNull(), rows).otherwise(share))
            .select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.col("turn").alias("_t"),
                    F.when(F.col("_n") > rows, F.ceil(F.col("_n") * 2 / rows)).otherwise(1).cast("long").alias("_k")))
    t = t.join(small(cut(over)), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p"))
               & F.col("turn").eqNullSafe(F.col("_t")), "left")
    at = F.pmod(_dealt(F.concat(F.lit("piece|"), "role", F.lit("|"), "text")), F.col("_k"))
    piece = F.when(F.col("_k").isNull(), 0).when(F.col("turn").isNull(), at).otherwise(1 + F.pmod("turn", F.lit(part)) + part * at)
    return t.withColumn("part", (F.col("part") + piece * PIECE).cast("long")).drop("_c", "_p", "_t", "_k")


def rotate(turns: DataFrame, part: int = PART, rows: int = ROWS) -> DataFrame:
    """conv_id, speaker, part, n_turns, text, spans (start, end in characters;
    what the assistant writes) of ``turns`` (conv_id, turn, role, text)."""
    t = _in_pieces(_parts(turns, part), turns, part, rows)
    speakers = (t.where("role <> 'system'").select(F.col("conv_id").alias("_c"), F.col("role").alias("speaker"))
                .dropDuplicates())
    said = t.join(speakers, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    turn = F.struct("turn", "role", "text", _head(F.col("role"), F.col("speaker")).alias("head"),
                    (F.col("role") == F.col("speaker")).alias("own"))
    whole = said.groupBy("conv_id", "speaker", "part").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["head"])
        end = begin + F.char_length(x["text"]) + F.lit(len(END))
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(x["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    text = F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["text"], F.lit(END))), "")
    return whole.select("conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"),
                        F.aggregate("turns", start, add)["spans"].alias("spans"))


ORACLE = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
n AS (
  SELECT *, coalesce(floor(turn / 64.0)::BIGINT, -1 - ('0x' || substr(md5(text), 1, 8))::BIGINT % 1024) AS part0 FROM t),
k AS (
  SELECT *, count(*) OVER (PARTITION BY conv_id, part0, turn) AS same,
         CASE WHEN same > 16384 THEN ceil(same * 2 / 16384.0)::BIGINT ELSE 1 END AS pieces,
         ('0x' || substr(md5('piece|' || role || '|' || text), 1, 8))::BIGINT % pieces AS piece
  FROM n),
u AS (
  SELECT conv_id, turn, role, text, part0 + (CASE WHEN turn IS NULL THEN piece WHEN same <= 256 THEN 0
    ELSE 1 + (turn % 64 + 64) % 64 + 64 * piece END)::BIGINT * 4398046511104 AS part
  FROM k),
r AS (
  SELECT t.conv_id, speaker, part, turn, role, text,
         '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = speaker THEN 'assistant'
                                ELSE 'user name=' || role END || chr(10) AS head
  FROM u t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
p AS (
  SELECT *, length(head) + length(text) + 11 AS n,
         sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, speaker, part ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS to_
  FROM r)
SELECT conv_id, speaker, part, count(*) AS n_turns,
       string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text,
       coalesce(string_agg(CASE WHEN role = speaker THEN (to_ - n + length(head)) || '-' || to_ END, ',' ORDER BY turn, role, text), '') AS mask
FROM p GROUP BY conv_id, speaker, part
"""


@register("op6_perspective_rotation", ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    mask = F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x["start"], x["end"])), ",")
    return rotate(table(spark, sf_dir, "conversations")).select(
        "conv_id", "speaker", "part", "n_turns", "text", mask.alias("mask"))
