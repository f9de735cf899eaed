"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context, and
only that reply is trainable. Turns that follow the last reply belong to no reply; they are
kept in one more example without a trainable span, so that no turn is lost. A conversation
without an assistant turn is only that last example.

The template puts START role, a line feed, the text, END and a line feed around a turn.
Inside texts and roles a backslash goes between "<" and "|", one more for every one that
stands there already, so that no control string survives and the step can be undone. Roles
also have their backslashes doubled and their line feeds written as backslash n.

Defined results: a null text or role counts as empty; turns go by turn number, then role,
then text, nulls first, and repeated rows stay as repeated turns; a null conv_id is one
conversation; an empty table gives an empty result; other columns are not read. A conversation
has to fit one value of a row, as an example is one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
REPLY_ROLE = "assistant"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape_text(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    pieces = F.split(unescape_text(role), r"\\\\", -1)
    undone = F.transform(pieces, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(undone, "\\")


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its turns in order as (role, text)."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def chat_examples(turns: DataFrame) -> DataFrame:
    """conv_id, example (from 0), text, loss_start and loss_chars (code points; 0 and 0: none)."""
    head = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
    body = lambda t: escape_text(t["text"])
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            head(t).alias("head"), body(t).alias("body"), (t["role"] == REPLY_ROLE).alias("reply")
        ),
    )
    replies = F.filter(
        F.sequence(F.lit(1), F.size("pieces")), lambda i: F.get("pieces", i - 1)["reply"]
    )
    rest = F.array(F.size("pieces"))
    ends_open = ~F.element_at("pieces", -1)["reply"]
    targets = F.when(ends_open, F.concat(replies, rest)).otherwise(replies)
    rendered = lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))
    last = F.get("pieces", F.col("target") - 1)
    return (
        conversations(turns)
        .select("conv_id", pieces.alias("pieces"))
        .select("conv_id", "pieces", F.posexplode(targets).alias("example", "target"))
        .select(
            "conv_id",
            "example",
            F.array_join(F.transform(F.slice("pieces", 1, F.col("target")), rendered), "").alias("text"),
            last.alias("last"),
        )
        .select(
            "conv_id",
            "example",
            "text",
            F.when(
                F.col("last.reply"),
                F.length("text") - F.length("last.body") - len(END) - 1,
            ).otherwise(0).alias("loss_start"),
            F.when(F.col("last.reply"), F.length("last.body")).otherwise(0).alias("loss_chars"),
        )
    )


def example_turns(text: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    parts = F.split(text, r"<\|im_end\|>\n", -1)
    whole = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = F.substring(part, F.length(role) + 2, F.length(part))
        return F.struct(
            unescape_role(F.substring(role, len(START) + 1, F.length(role))).alias("role"),
            unescape_text(body).alias("text"),
        )

    return F.transform(whole, turn)


def loss_text(text: Column, start: Column, chars: Column) -> Column:
    """The text under the loss mask, without escapes."""
    return unescape_text(F.substring(text, start + 1, chars))


def chat_digest(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read from their texts and masks."""
    lines = F.transform(
        example_turns(F.col("longest")),
        lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")),
    )
    trained = F.array_join(F.transform(F.array_sort("replies"), lambda r: r["loss"]), "")
    loss = loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars"))
    return (
        examples.groupBy("conv_id")
        .agg(
            F.max_by("text", "example").alias("longest"),
            F.collect_list(F.struct("example", loss.alias("loss"))).alias("replies"),
            F.sum(F.length("text")).alias("formatted_chars"),
        )
        .select("conv_id", lines.alias("lines"), trained.alias("trained"), "formatted_chars")
        .select(
            "conv_id",
            F.size("lines").cast("bigint").alias("n_turns"),
            F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("turns_sha256"),
            F.length("trained").cast("bigint").alias("loss_chars"),
            F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
            F.col("formatted_chars").cast("bigint").alias("formatted_chars"),
        )
    )
