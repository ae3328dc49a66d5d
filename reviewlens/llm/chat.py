"""Chat formatting with a reversible template and a loss mask. DataFrame functions only.

A turn is written ``<|im_start|>role``, a line break, its text and ``<|im_end|>`` with a line break.
Adjacent turns of one role share one such block, their texts divided by ``<|im_sep|>``. Inside roles
and texts a backslash is doubled and ``<|`` becomes ``<`` backslash ``|``, so that no control string
is left; a line break in a role becomes a backslash and ``n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import running

START, END, DIVIDE = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    """The text that was escaped: between doubled backslashes, a backslash belongs to what follows it."""
    part = lambda x: F.replace(F.replace(x, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n"))
    parts = F.transform(F.split(text, r"\\\\", -1), part)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def format_turns(rows: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``id_col``, ``formatted`` and ``loss_spans``.

    ``loss_spans`` are structs ``start, size`` (code points of ``formatted``) of the assistant's
    texts, one per turn, still escaped and without control strings.

    Turns are sorted by number, equal numbers by role and text; repeated rows stay. A null role or
    text counts as empty, a null number comes first, and rows with a null id are one conversation.
    Other columns are ignored. No rows give no rows. A conversation is one row of the result and so
    is gathered whole; that is the only group that is.
    """
    said = rows.select(
        F.col(id_col).alias("_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("said"),
    )
    talks = said.groupBy("_id").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    # What stands before a turn's text: a new block, or the division inside the block of the same role.
    opened = F.transform(
        "turns",
        lambda t, i: F.struct(
            F.when((i > 0) & (F.get("turns", i - 1)["role"] == t["role"]), F.lit(DIVIDE))
            .otherwise(F.concat(F.when(i > 0, END).otherwise(""), F.lit(START), escaped_role(t["role"]), F.lit("\n")))
            .alias("before"),
            escaped(t["text"]).alias("text"),
            (t["role"] == "assistant").alias("loss"),
        ),
    )
    talks = talks.select("_id", opened.alias("turns"))
    formatted = F.concat(F.array_join(F.transform("turns", lambda t: F.concat(t["before"], t["text"])), ""), F.lit(END))
    size = lambda part: F.transform("turns", lambda t: F.length(t[part]))
    talks = talks.select(
        "_id", formatted.alias("formatted"), size("before").alias("before"), size("text").alias("size"),
        F.transform("turns", lambda t: t["loss"]).alias("loss"),
    )
    at = F.zip_with(running(F.zip_with("before", "size", lambda x, y: x + y)), "before", lambda x, y: x + y)
    every = F.arrays_zip(at.alias("start"), F.col("size"), F.col("loss"))
    spans = F.transform(F.filter(every, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["size"].alias("size")))
    return talks.select(F.col("_id").alias(id_col), "formatted", spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns (structs ``role, text``) of a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda b: b != "")
    head = lambda b: F.substring_index(b, "\n", 1)
    body = lambda b: F.substr(b, F.length(head(b)) + 2, F.length(b) - F.length(head(b)) - 1 - len(END))
    turns = F.transform(
        blocks,
        lambda b: F.transform(
            F.split(body(b), r"<\|im_sep\|>", -1),
            lambda x: F.struct(unescaped(head(b)).alias("role"), unescaped(x).alias("text")),
        ),
    )
    return F.flatten(turns)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one after the other."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["size"]))), "")
