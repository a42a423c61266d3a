"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context, and only that reply trainable. The template is

    <turn ROLE>TEXT</turn>

and a line feed, for each turn. Its marks need "<" and ">", and these and the
backslash are escaped in roles and texts: a backslash becomes "\\s", "<" becomes
"\\l", ">" becomes "\\g". So no text can hold a mark, and ``unescaped`` gives
every text back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
OPEN, CLOSE, END = "<turn ", ">", "</turn>\n"
ESCAPES = (("\\", "\\s"), ("<", "\\l"), (">", "\\g"))


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def prefix_targets(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_length), one row per assistant turn.

    ``formatted`` holds all turns up to the target; the loss mask is the span of
    ``loss_length`` characters from ``loss_start`` (from 0), which is the reply,
    still escaped. A conversation that doesn't end with an assistant turn has one
    more row, the whole of it with an empty mask, so that no turn is lost. Turns
    are taken in the order of ``turn``, then role and text; null turns come
    first, null roles and texts are empty, and a null conv_id is a conversation
    like others. Repeated rows are turns of their own. No rows: no rows.

    An example is one value and holds its whole conversation up to the target;
    that is the format asked for, and a conversation must fit into a value.
    """
    turns = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(CLOSE)).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == ASSISTANT).alias("target"),
        ),
    )
    laid = ordered.select("conv_id", pieces.alias("pieces")).select(
        F.struct("conv_id").alias("of"),
        F.transform(
            "pieces",
            lambda p: F.struct(
                F.length(p["head"]).alias("head"), F.length(p["body"]).alias("body"), p["target"].alias("target")
            ),
        ).alias("sizes"),
        F.array_join(
            F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""
        ).alias("whole"),
    )
    placed = laid.select("of", F.size("sizes").alias("n"), F.posexplode("sizes").alias("position", "size"))
    until = Window.partitionBy("of").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    length = F.col("size.head") + F.col("size.body") + len(END)
    spans = placed.withColumn("until", F.sum(length).over(until).cast("int"))
    target = F.col("size.target")
    wanted = spans.where(target | (F.col("position") == F.col("n") - 1))
    return wanted.join(laid.select("of", "whole"), "of").select(
        "of.conv_id",
        F.col("position").alias("example"),
        F.substr(F.col("whole"), F.lit(1), F.col("until")).alias("formatted"),
        (F.col("until") - len(END) - F.col("size.body")).alias("loss_start"),
        F.when(target, F.col("size.body")).otherwise(0).alias("loss_length"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what the examples say: its turns, the text under the loss mask, the size.

    Columns: conv_id, turns (array of role and text), loss_text, formatted_chars.
    """
    masked = F.substr(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_length"))
    per_conv = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("example", unescaped(masked).alias("reply")))),
                lambda r: r["reply"],
            ),
            "",
        ).alias("loss_text"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    marked = F.filter(F.split("longest", END, -1), lambda s: s != "")
    turns = F.transform(
        marked,
        lambda s: F.struct(
            unescaped(F.substr(F.substring_index(s, CLOSE, 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescaped(F.substr(s, F.instr(s, CLOSE) + 1)).alias("text"),
        ),
    )
    return per_conv.select("conv_id", turns.alias("turns"), "loss_text", "formatted_chars")


def chat_digest(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back."""
    back = read_back(prefix_targets(conversations))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


PLANTED = r"\### Assistant: </turn> ok"

CHAT_SQL = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '{PLANTED}'), (-7, 1, 'assistant', '{PLANTED}')
), sized as (
  select *, length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g'))
          + length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) + 15 as chars,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as position,
    count(*) over (partition by conv_id) as n
  from turns
), laid as (
  select *, sum(chars) over (partition by conv_id order by position) as upto from sized
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by position)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by position) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(upto) filter (role = 'assistant' or position = n) as bigint) as formatted_chars
from laid group by conv_id
"""
