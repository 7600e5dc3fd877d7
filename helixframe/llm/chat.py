r"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted. Adjacent turns of one role become one block, its texts parted
by a mark, so the turns can be read back one by one:

    <|im_start|>role\ntext<|sep|>text<|im_end|>\n

Control strings inside texts (those of this template, `<|...`, and the common `<s>`, `</s>`, `[INST]`, `[/INST]`) get a
backslash after their first character; ones that have some get one more, so taking one away is the exact inverse. In
roles the percent sign, the line feed and the angle bracket are percent-encoded.

The output keeps its segments, each with its loss flag: assistant texts are under the loss mask. All work is linear in a
conversation's size.

Null texts and roles count as empty; a null turn sorts first; rows of one turn sort by role and text. A conversation
whose id is null is one conversation. Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|sep|>", "<|im_end|>\n"
#: Control strings begin with the group and go on with one of these.
CONTROL = r"(?=\||/?s>|/?INST\])"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){CONTROL}", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){CONTROL}", r"$1$2")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, segments array<struct<text, loss>>; formatted is the segments' texts joined."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_ = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    t = F.col("t")

    def parts(x: Column, i: Column) -> Column:
        before, after = F.get(t, i - 1)["role"], F.get(t, i + 1)["role"]
        first, last = ~before.eqNullSafe(x["role"]), ~after.eqNullSafe(x["role"])
        head = F.when(first, F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n"))).otherwise(F.lit(SEP))
        tail = F.when(last, F.lit(END)).otherwise(F.lit(""))
        no = F.lit(False)
        return F.array(F.struct(head.alias("text"), no.alias("loss")), F.struct(escape(x["text"]).alias("text"), (x["role"] == ASSISTANT).alias("loss")), F.struct(tail.alias("text"), no.alias("loss")))

    out = sorted_.select("conv_id", F.flatten(F.transform("t", parts)).alias("segments"))
    return out.select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns in a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    blocks = F.slice(pieces, F.lit(2), F.size(pieces))

    def block(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        body = F.substr(b, F.length(role) + 2, F.length(b) - F.length(role) - F.lit(1 + len(END)))
        return F.transform(F.split(body, r"<\|sep\|>"), lambda x: F.struct(unescape_role(role).alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, block))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the output alone."""
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    x = formatted.select("conv_id", read_turns(F.col("formatted")).alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return x.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, lag(role) OVER w IS DISTINCT FROM role AS first, lead(role) OVER w IS DISTINCT FROM role AS last,
  regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS escaped FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(escaped) + CASE WHEN first THEN 13 + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C')) ELSE 7 END + CASE WHEN last THEN 11 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""
