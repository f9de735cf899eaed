"""Row formatting: turn a raw text into a training prompt. Null means the row failed."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.config import SpecialTokens
from corpusloom.functions.chat import (
    line_conversation,
    parse_conversation,
    render_chat,
    render_turns,
)
from corpusloom.functions.text import strip_unicode


def wrap(text: Column, tokens: SpecialTokens) -> Column:
    """The text, unchanged, between the begin and end tokens."""
    return F.concat(F.lit(tokens.bos), text, F.lit(tokens.eos))


def strip_wrap(text: Column, tokens: SpecialTokens) -> Column:
    return wrap(strip_unicode(text), tokens)


def json_content(text: Column, tokens: SpecialTokens) -> Column:
    """Wrap the string under "content" of a JSON object; anything else fails.

    The parser reads one value and leaves what follows it. Inside an object as well as
    inside an array, nothing can follow the value unnoticed.
    """
    inside = F.try_parse_json(F.concat(F.lit('{"value":'), text, F.lit("}")))
    single = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()
    content = F.try_variant_get(inside, "$.value.content", "variant")
    is_string = F.schema_of_variant(content) == "STRING"
    return F.when(single & is_string, wrap(F.try_variant_get(content, "$", "string"), tokens))


def json_in_python(text: str, tokens: SpecialTokens) -> tuple[str | None, str | None]:
    """The same by Python's reader: the prompt, or else why there is none."""
    try:
        content = json.loads(text)["content"]
        if not isinstance(content, str):
            raise TypeError("content is no string")
        content.encode("utf-8")
        return tokens.bos + content + tokens.eos, None
    except (ValueError, TypeError, LookupError, RecursionError) as error:
        return None, f"{type(error).__name__}: {error}"[:200]


def chat_or_wrap(text: Column, instruct: Column, tokens: SpecialTokens) -> Column:
    """Marked chat in the instruct phase; the wrapped text where there is no conversation."""
    if tokens.end_marker is None:
        return wrap(text, tokens)
    # A text has at least one pair of parts exactly where it holds an end marker.
    has_turns = text.contains(tokens.end_marker)
    chat = render_turns(parse_conversation(text, tokens), tokens)
    return F.when(instruct & has_turns, chat).otherwise(wrap(text, tokens))


def line_chat(text: Column, instruct: Column, tokens: SpecialTokens) -> Column:
    """Lines alternate between user and assistant in the instruct phase."""
    return F.when(instruct, render_chat(line_conversation(text), tokens)).otherwise(
        wrap(text, tokens)
    )


@F.pandas_udf(T.StringType())
def format_float(values: pd.Series) -> pd.Series:
    """Scientific with two digits below 0.01, else four decimals.

    Python's formatting rounds the exact binary value; Java's rounds the shortest decimal and
    differs at ties. Meant for report rows, which are few.
    """

    def one(value: float) -> str:
        return f"{value:.2e}" if value != 0 and abs(value) < 0.01 else f"{value:.4f}"

    return values.map(one, na_action="ignore")


@F.pandas_udf(T.StringType())
def format_fixed(values: pd.Series) -> pd.Series:
    """Two decimals, rounded as Python does it."""
    return values.map("{:.2f}".format, na_action="ignore")


def format_metrics(floats: dict[str, Column], others: dict[str, Column] | None = None) -> Column:
    """Named values as "key: value | key: value"; floats first, then the others as they are."""
    parts = [F.concat(F.lit(f"{k}: "), format_float(c)) for k, c in floats.items()]
    parts += [F.concat(F.lit(f"{k}: "), c.cast("string")) for k, c in (others or {}).items()]
    return F.concat_ws(" | ", *parts)
