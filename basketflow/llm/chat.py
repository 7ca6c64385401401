"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered once with that speaker as the
assistant and all others as named users; the mask covers what the assistant says. ``system``
messages are no participant's: they stay what they are in every rendering and are never masked in.

A message is rendered as ``<|im_start|>HEAD\\nTEXT<|im_end|>\\n``; HEAD is ``assistant``, ``system`` or
``user name=SPEAKER``. The mark ``<|`` inside a text or name is written ``<\\|`` so that no message can
forge a turn. Spans count characters (code points), end exclusive, from TEXT's first character to
the end of its ``<|im_end|>``.

Defined results: a null text is an empty message, a null role is the speaker ``unknown``; repeated
rows are one message (the table is a set); different messages on one turn follow each other by role
and text. A dialogue is one row for each participant up to turn ``PART``; beyond, it goes on in further rows, so that no row
holds an unbounded conversation, and nothing is lost. A message without a turn number is a part of
its own (numbered below zero by its hash). The rows of a dialogue are its messages times its participants. Messages without a conversation id share the id null.
A conversation of nothing but system messages has no participant and no row. An empty table gives no
rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.base import table

#: Turn numbers in one rendered row.
PART = 1 << 16
START, END = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def messages(conversations: DataFrame, part: int = PART) -> DataFrame:
    """One row per distinct message: conversation, part, turn, speaker, text without forged marks."""
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit("unknown"))
    rows = conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("turn"), _plain(role).alias("role"), _plain(text).alias("text")
    ).distinct()
    alone = -1 - F.conv(F.substring(F.md5(F.concat("role", F.lit("\n"), "text")), 1, 8), 16, 10).cast("bigint")
    return rows.withColumn("part", F.when(F.col("turn").isNull(), alone).otherwise(F.floor(F.col("turn") / part)).cast("long"))


def perspectives(said: DataFrame) -> DataFrame:
    """Every message once for each participant of its conversation: a shuffle join on the conversation."""
    speakers = (
        said.filter(F.col("role") != "system")
        .select(F.col("conv").alias("of"), F.col("role").alias("speaker"))
        .distinct()
    )
    seen = said.join(speakers, F.col("conv").eqNullSafe(F.col("of")))
    own = F.col("role") == F.col("speaker")
    head = (
        F.when(own, F.lit("assistant"))
        .when(F.col("role") == "system", F.lit("system"))
        .otherwise(F.concat(F.lit("user name="), "role"))
    )
    return seen.select(
        "conv", "speaker", "part", "turn", "role", "text",
        own.alias("own"),
        F.concat(F.lit(START), head, F.lit("\n")).alias("head"),
        F.concat("text", F.lit(END)).alias("body"),
    )


def rotate(conversations: DataFrame, part: int = PART) -> DataFrame:
    """One row per conversation, participant and part: the rendered dialogue and its mask spans."""
    seen = perspectives(messages(conversations, part))
    turns = F.sort_array(
        F.collect_list(
            F.struct("turn", "role", "text", "own", "head", "body",
                     (F.char_length("head") + F.char_length("body") + 1).alias("width"))
        )
    )
    packed = seen.groupBy("conv", "speaker", "part").agg(turns.alias("turns"))
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans")),
        lambda done, t: F.struct(
            (done["at"] + t["width"]).alias("at"),
            F.when(
                t["own"],
                F.concat(
                    done["spans"],
                    F.array(F.struct(
                        (done["at"] + F.char_length(t["head"])).alias("start"),
                        (done["at"] + t["width"] - 1).alias("end"),
                    )),
                ),
            ).otherwise(done["spans"]).alias("spans"),
        ),
    )["spans"]
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))), "")
    return packed.select(
        F.col("conv").alias("conv_id"), F.col("speaker"), "part",
        F.size("turns").cast("long").alias("n_messages"),
        rendered.alias("rendered"), spans.alias("mask"),
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mask spans are joined as ``start:end`` with commas, so that rows compare as plain values."""
    return rotate(table(spark, sf_dir, "conversations")).withColumn(
        "mask", F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    )


OP8_SQL = r"""
with said as (
  select distinct conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '<\|') as role,
         replace(coalesce(text, ''), '<|', '<\|') as text
  from conversations
), speakers as (
  select distinct conv_id, role as speaker from said where role <> 'system'
), seen as (
  select s.conv_id, p.speaker, case when s.turn is not null then cast(floor(s.turn / 65536) as bigint)
           else -1 - cast('0x' || substr(md5(s.role || chr(10) || s.text), 1, 8) as bigint) end as part, s.turn, s.role, s.text,
         s.role = p.speaker as own,
         '<|im_start|>' || case when s.role = p.speaker then 'assistant' when s.role = 'system' then 'system'
                           else 'user name=' || s.role end || chr(10) as head,
         s.text || '<|im_end|>' as body
  from said s join speakers p on s.conv_id is not distinct from p.conv_id
), placed as (
  select *, sum(length(head) + length(body) + 1) over (
              partition by conv_id, speaker, part order by turn, role, text) as upto
  from seen
)
select conv_id, speaker, part, count(*) as n_messages,
       string_agg(head || body || chr(10), '' order by turn, role, text) as rendered,
       coalesce(string_agg(case when own then (upto - length(body) - 1)::bigint || ':' || (upto - 1)::bigint end, ','
                           order by turn, role, text), '') as mask
from placed group by conv_id, speaker, part
"""
