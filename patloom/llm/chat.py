r"""Conversations as training text, with a loss mask, in Spark expressions only.

A run of turns of one role is a block `<s>[INST]role[/INST]text[TURN]text...</s>`. Inside roles and
texts every control string gets a backslash behind its bracket (`<\/s>`), and one that has backslashes
there already gets one more, so that taking one away gives the text back whatever it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.llm.registry import query, table

OPEN, MID, NEXT, CLOSE = "<s>[INST]", "[/INST]", "[TURN]", "</s>"
CONTROL = r"/?(?:s>|INST\]|TURN\])"  # what follows the bracket of a control string


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*{CONTROL})", r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*{CONTROL})", "$1$2")


def joined(pieces: Column) -> Column:
    return F.array_join(pieces, "")


def conversation_turns(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation with its turns (role, text) in order.

    Order is by turn, then role and text, so ties have one order and repeated rows stay. A null role or
    text is empty; rows without a conversation id form one conversation. The turns of a conversation
    make one row, as its training text does.
    """
    rows = df.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("item"),
    )
    return rows.groupBy("conv").agg(F.array_sort(F.collect_list("item")).alias("turns"))


def merged(turns: DataFrame) -> DataFrame:
    """Adjacent turns of one role as one block (role, texts)."""
    at = turns.select("conv", "turns", F.transform("turns", lambda t: t["role"]).alias("roles"))
    starts = at.select(
        "conv",
        "turns",
        F.filter(
            F.sequence(F.lit(0), F.size("roles") - 1),
            lambda i: (i == 0) | (F.get("roles", i) != F.get("roles", i - 1)),
        ).alias("starts"),
    )
    block = lambda start, k: F.struct(
        F.get("turns", start)["role"].alias("role"),
        F.transform(
            F.slice("turns", start + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - start), lambda t: t["text"]
        ).alias("texts"),
    )
    return starts.select("conv", F.transform("starts", block).alias("blocks"))


def formatted(blocks: DataFrame, learned: str = "assistant") -> DataFrame:
    """Add `segments` (piece, loss), which in a row make the text, and the `formatted` text itself.

    `loss` is true for the texts of the learned role, one segment each.
    """
    mark = lambda piece: F.struct(piece.alias("piece"), F.lit(False).alias("loss"))
    lead = lambda block, j: F.when(j > 0, F.lit(NEXT)).otherwise(F.concat(F.lit(OPEN), escaped(block["role"]), F.lit(MID)))
    body = lambda block: F.flatten(
        F.transform(
            block["texts"],
            lambda text, j: F.array(
                mark(lead(block, j)), F.struct(escaped(text).alias("piece"), (block["role"] == learned).alias("loss"))
            ),
        )
    )
    pieces = F.flatten(F.transform("blocks", lambda block: F.concat(body(block), F.array(mark(F.lit(CLOSE))))))
    rows = blocks.select("conv", pieces.alias("segments"))
    return rows.select("conv", "segments", joined(F.transform("segments", lambda s: s["piece"])).alias("formatted"))


def format_chat(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, the `formatted` text and its `segments` (piece, loss)."""
    return formatted(merged(conversation_turns(df, conv, turn, role, text)), learned).withColumnRenamed("conv", conv)


def parsed_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted text, unescaped."""
    whole = F.filter(F.split(text, CLOSE, -1), lambda block: block != "")
    parts = F.transform(whole, lambda block: F.split(F.substr(block, F.lit(len(OPEN) + 1)), r"\[/INST\]", 2))
    return F.flatten(
        F.transform(
            parts,
            lambda part: F.transform(
                F.split(F.get(part, F.lit(1)), r"\[TURN\]", -1),
                lambda turn: F.struct(unescaped(F.get(part, F.lit(0))).alias("role"), unescaped(turn).alias("text")),
            ),
        )
    )


def learned_text(segments: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return joined(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["piece"])))


SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
        regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]|TURN\]))', '\1\\\2', 'g') AS shown,
        regexp_replace(role, '([<\[])(\\*/?(?:s>|INST\]|TURN\]))', '\1\\\2', 'g') AS shown_role
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(shown) + CASE WHEN before = role THEN length('[TURN]')
        ELSE length(shown_role) + length('<s>[INST][/INST]</s>') END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""


@query("op9_chat", SQL)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, then read back: turns from the text, the rest from its mask."""
    told = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", told), (-1, 1, "assistant", told)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = format_chat(rows).select(
        "conv_id",
        parsed_turns(F.col("formatted")).alias("turns"),
        learned_text(F.col("segments")).alias("learned"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    told_turns = joined(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told_turns, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )
