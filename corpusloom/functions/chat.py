"""Conversations as arrays of (role, content), parsed from text and rendered to prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.config import SpecialTokens
from corpusloom.functions.text import literal_pattern, not_blank, strip_unicode


def split_marker(text: Column, marker: str) -> Column:
    """Split on the literal marker and keep trailing empty parts."""
    return F.split(text, literal_pattern([marker]), -1)


def _message(position: Column, user: Column, assistant: Column) -> Column:
    is_user = position % 2 == 0
    return F.struct(
        F.when(is_user, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.when(is_user, user).otherwise(assistant).alias("content"),
    )


def parse_conversation(text: Column, tokens: SpecialTokens) -> Column:
    """Parts between end markers, taken two by two as user and assistant.

    The role comes from the position. A last part without a partner is left out.
    """
    parts = split_marker(text, tokens.end_marker)

    def message(part: Column, position: Column) -> Column:
        return _message(
            position,
            strip_unicode(F.replace(part, F.lit(tokens.user_marker), F.lit(""))),
            strip_unicode(F.replace(part, F.lit(tokens.bot_marker), F.lit(""))),
        )

    paired = F.size(parts) - F.size(parts) % 2
    return F.slice(F.transform(parts, message), F.lit(1), paired)


def line_conversation(text: Column) -> Column:
    """Lines as messages; blank lines count for the role parity, then fall away."""
    lines = F.transform(
        F.split(text, "\n", -1), lambda line, position: _message(position, line, line)
    )
    return F.filter(lines, lambda message: not_blank(message["content"]))


def valid_alternation(conversation: Column) -> Column:
    """True where roles run user, assistant, user, ... and no other role occurs."""
    checks = F.transform(
        conversation,
        lambda message, position: message["role"].isin("user", "assistant")
        & ((message["role"] == "user") == (position % 2 == 0)),
    )
    return F.forall(checks, lambda ok: F.coalesce(ok, F.lit(False)))


def render_turns(conversation: Column, tokens: SpecialTokens) -> Column:
    """The prompt of a conversation whose roles are known to alternate."""

    def turn(message: Column) -> Column:
        is_user = message["role"] == "user"
        return F.concat(
            F.when(is_user, F.lit(tokens.user_marker)).otherwise(F.lit(tokens.bot_marker)),
            F.lit("\n"),
            message["content"],
            F.lit(tokens.end_marker + "\n"),
            F.when(is_user, F.lit("")).otherwise(F.lit(tokens.eos)),
        )

    return F.concat(F.lit(tokens.bos), F.array_join(F.transform(conversation, turn), ""))


def render_chat(conversation: Column, tokens: SpecialTokens) -> Column:
    """The conversation as one prompt; null where the roles do not alternate."""
    return F.when(valid_alternation(conversation), render_turns(conversation, tokens))
