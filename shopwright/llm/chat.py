"""Conversations as one training string each, built by Spark expressions only.

The turns of a conversation are collected as structs, sorted, and folded so that
adjacent turns of one role share a block. A block is ``<|im_start|>role\\n`` followed
by its texts, with ``<|im_sep|>`` between them, and ``<|im_end|>\\n``. Inside roles and texts
each ``<|`` is written ``<||``, so no text can contain a control string and the
original comes back by taking that bar away. A line break inside a role is written
``<|nl|>``. The loss mask covers every assistant text and nothing else.

One conversation is one row in the result, so its turns meet in one row by
necessity; conversations are spread over tasks by their id.

Defined cases: null texts and roles count as empty. Turns are sorted by turn, then
role and text, null turns first; repeated rows are repeated turns. A null conv_id
is a conversation of its own. Columns other than conv_id, turn, role and text are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopwright.llm.expr import filled, literal_rows

START, SEP, END, BREAK = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|nl|>"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescaped(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, and loss_spans: start (code points before it) and length of each learned text."""
    collected = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("turn", filled(F.col("role")).alias("role"), filled(F.col("text")).alias("text")))
        ).alias("turns")
    )
    # A turn opens a block when it is the first or its role differs from the turn before.
    opens = F.transform(
        "turns", lambda t, i: (i == 0) | (t["role"] != F.coalesce(F.get("turns", i - 1)["role"], F.lit("")))
    )
    marked = collected.withColumn("opens", opens)

    def head(turn: Column, i: Column) -> Column:
        role = F.replace(escaped(turn["role"]), F.lit("\n"), F.lit(BREAK))
        new = F.concat(F.when(i > 0, F.lit(END)).otherwise(F.lit("")), F.lit(START), role, F.lit("\n"))
        return F.when(F.get("opens", i), new).otherwise(F.lit(SEP))

    pieces = marked.withColumn(
        "pieces",
        F.transform(
            "turns",
            lambda t, i: F.struct(
                head(t, i).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == LEARNED).alias("learned")
            ),
        ),
    )
    # Running length: the state is the number of code points so far and the spans found.
    empty = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["head"])
        size = F.length(piece["body"])
        span = F.struct(start.alias("start"), size.alias("length"))
        return F.struct(
            (start + size).alias("at"),
            F.when(piece["learned"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    body = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "")
    return pieces.select(
        "conv_id",
        F.concat(body, F.lit(END)).alias("formatted"),
        F.aggregate("pieces", empty, step)["spans"].alias("loss_spans"),
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (structs of role and text in order) and loss (the learned texts), from formatted rows."""
    # Between markers only escaped text stands, so these strings occur as markers alone.
    blocks = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, F.size(F.split("formatted", r"<\|im_start\|>")))

    def turns_of(block: Column) -> Column:
        role = unescaped(F.replace(F.substring_index(block, "\n", 1), F.lit(BREAK), F.lit("\n")))
        rest = F.substr(block, F.length(F.substring_index(block, "\n", 1)) + 2)
        texts = F.split(F.left(rest, F.length(rest) - len(END)), r"<\|im_sep\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    loss = F.transform("loss_spans", lambda s: unescaped(F.substr("formatted", s["start"] + 1, s["length"])))
    return conversations.select(
        "conv_id", "formatted", F.flatten(F.transform(blocks, turns_of)).alias("turns"), loss.alias("loss")
    )


def probe(spark: SparkSession) -> DataFrame:
    """A conversation whose texts look like the template's own control strings."""
    text = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", text), (-1, 1, LEARNED, text)]
    return literal_rows(spark, rows, "conv_id bigint, turn bigint, role string, text string")


def chat_report(turns: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from its formatted string."""
    back = read_back(formatted(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
