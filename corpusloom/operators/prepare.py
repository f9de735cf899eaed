"""From raw texts to prepared prompts: filters, processors and error quarantine."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.config import SpecialTokens
from corpusloom.functions import formats
from corpusloom.functions.text import not_blank
from corpusloom.operators.positions import batch_numbers
from corpusloom.operators.safe_sql import calls, safe_result

Processor = Callable[[DataFrame, Column, SpecialTokens], DataFrame]

# SQL functions whose purpose is to raise.
_RAISING = frozenset({"raise_error", "assert_true"})

_PYTHON_RESULT = T.StructType(
    [T.StructField("result", T.StringType()), T.StructField("error", T.StringType())]
)


def drop_blank(df: DataFrame, column: str = "text") -> DataFrame:
    """Keep rows whose text holds more than whitespace; null rows fall away too."""
    return df.filter(not_blank(F.col(column)))


def drop_null_results(df: DataFrame, column: str = "result") -> DataFrame:
    """Keep rows whose processor gave a result; an empty string is a result."""
    return df.filter(F.col(column).isNotNull())


def _from_column(
    build: Callable[[Column, Column, SpecialTokens], Column], failure: str
) -> Processor:
    """A processor made of columns; a text it has no result for carries the failure as error."""

    def run(df: DataFrame, instruct: Column, tokens: SpecialTokens) -> DataFrame:
        failed = F.col("text").isNotNull() & F.col("result").isNull()
        return df.withColumn("result", build(F.col("text"), instruct, tokens)).withColumn(
            "error", F.when(failed, F.lit(failure))
        )

    return run


def _json_content(df: DataFrame, instruct: Column, tokens: SpecialTokens) -> DataFrame:
    """Native where the native reader gives a result; Python's reader judges all other rows.

    The native reader refuses strings above 20 million characters and deep nesting, which
    Python's takes. Rows with a native result reach Python as null.
    """

    read = formats.json_in_python

    @F.arrow_udf(_PYTHON_RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        rows = [(None, None) if t is None else read(t, tokens) for t in texts.to_pylist()]
        columns = list(zip(*rows, strict=True)) or [(), ()]
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.string()) for c in columns], ["result", "error"]
        )

    native = df.withColumn("__native", formats.json_content(F.col("text"), tokens))
    refused = F.when(F.col("__native").isNull(), F.col("text"))
    return (
        native.withColumn("__judged", judge(refused))
        .withColumns(
            {
                "result": F.coalesce("__native", "__judged.result"),
                "error": F.col("__judged.error"),
            }
        )
        .drop("__native", "__judged")
    )


BUILT_IN: dict[str, Processor] = {
    "default": _from_column(formats.chat_or_wrap, "no prompt"),
    "wrap": _from_column(lambda text, _, tokens: formats.wrap(text, tokens), "no prompt"),
    "strip_wrap": _from_column(lambda text, _, tokens: formats.strip_wrap(text, tokens), "no prompt"),
    "json_content": _json_content,
    "line_chat": _from_column(formats.line_chat, "roles do not alternate"),
}


def sql_processor(expression: str) -> Processor:
    """A SQL expression over text, bos, eos and isinst; it runs in generated code.

    No input can make it fail the job: a failing cast, division or reader gives null for its row,
    and an expression that could raise is refused when the plan is made. A result is taken as a
    string.
    """
    raising = calls(expression) & _RAISING
    if raising:
        raise ValueError(f"{', '.join(sorted(raising))} would fail the job, not the row")

    def run(df: DataFrame, instruct: Column, tokens: SpecialTokens) -> DataFrame:
        constants = {"bos": F.lit(tokens.bos), "eos": F.lit(tokens.eos)}
        result = safe_result(df, expression, constants, {"isinst": instruct})
        return result.withColumn("error", F.lit(None).cast("string"))

    return run


def python_processor(function: Callable[[str, SpecialTokens, bool], str | None]) -> Processor:
    """A Python callable (text, tokens, instruct) -> str or None, run over Arrow batches.

    An exception rejects the one row and is kept as its error.
    """

    def run(df: DataFrame, instruct: Column, tokens: SpecialTokens) -> DataFrame:
        def one(text: str | None, flag: bool) -> tuple[str | None, str | None]:
            if text is None:
                return None, None
            try:
                result = function(text, tokens, flag)
                if result is not None and not isinstance(result, str):
                    return None, f"TypeError: {type(result).__name__} is not a text"
                return result, None
            except Exception as error:  # noqa: BLE001 - any failure rejects the row only
                return None, f"{type(error).__name__}: {error}"

        @F.pandas_udf(_PYTHON_RESULT)
        def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for texts, flags in batches:
                rows = [one(t, bool(f)) for t, f in zip(texts, flags)]
                yield pd.DataFrame(rows, columns=["result", "error"], dtype=object)

        return (
            df.withColumn("__out", apply("text", instruct))
            .withColumns({"result": F.col("__out.result"), "error": F.col("__out.error")})
            .drop("__out")
        )

    return run


def resolve(processor: str | Processor) -> Processor:
    """A built-in processor by name, a SQL expression, or a processor as it is."""
    if callable(processor):
        return processor
    return BUILT_IN.get(processor) or sql_processor(processor)


def prepare(
    df: DataFrame,
    processor: str | Processor,
    instruct: bool | Column,
    tokens: SpecialTokens = SpecialTokens(),
) -> DataFrame:
    """Prepared rows: blank texts, failed rows and null results are left out.

    Scan, filter and projection only: one stage, no shuffle, also on a stream.
    """
    flag = instruct if isinstance(instruct, Column) else F.lit(instruct)
    formatted = resolve(processor)(drop_blank(df), flag, tokens)
    return (
        drop_null_results(formatted)
        .drop("text", "error")
        .withColumnRenamed("result", "text")
    )


def quarantine(
    df: DataFrame,
    processor: str | Processor,
    instruct: bool | Column,
    tokens: SpecialTokens = SpecialTokens(),
) -> DataFrame:
    """Every row with its result and a reject_reason: blank, error, null_result or null."""
    flag = instruct if isinstance(instruct, Column) else F.lit(instruct)
    usable = F.coalesce(not_blank(F.col("text")), F.lit(False))
    # Blank rows reach the processor as null and come back as null.
    guarded = df.withColumn("__raw", F.col("text")).withColumn(
        "text", F.when(usable, F.col("text"))
    )
    processed = resolve(processor)(guarded, flag, tokens)
    reason = (
        F.when(F.col("text").isNull(), F.lit("blank"))
        .when(F.col("error").isNotNull(), F.lit("error"))
        .when(F.col("result").isNull(), F.lit("null_result"))
    )
    return (
        processed.withColumn("reject_reason", reason)
        .withColumn("result", F.when(F.col("reject_reason").isNull(), F.col("result")))
        .withColumn("text", F.col("__raw"))
        .drop("__raw")
    )


KEPT, REJECTED = "kept", "rejected"
REJECT_REASONS = ("blank", "error", "null_result")


def split_rows(
    df: DataFrame,
    processor: str | Processor,
    instruct: bool | Column,
    tokens: SpecialTokens = SpecialTokens(),
) -> DataFrame:
    """Every row once, with its status: prepared text of kept rows, raw text of rejected ones.

    One pass: the processor runs once for a row, whichever way it goes. Rejected rows carry
    reject_reason and, where there is one, the error.
    """
    judged = quarantine(df, processor, instruct, tokens)
    kept = F.col("reject_reason").isNull()
    return (
        judged.withColumn("text", F.when(kept, F.col("result")).otherwise(F.col("text")))
        .withColumn("status", F.when(kept, KEPT).otherwise(REJECTED))
        .drop("result")
    )


def empty_batches(
    df: DataFrame, order: list[str], size: int, survived: Column, strict: bool = False
) -> DataFrame:
    """Formatting batches in which no row survived. In strict mode such a batch fails the job."""
    flags = df.select(*order, survived.cast("int").alias("__ok"))
    batches = (
        batch_numbers(flags, order, size)
        .groupBy("batch_no")
        .agg(F.count("*").alias("n_rows"), F.sum("__ok").cast("bigint").alias("n_valid"))
        .filter(F.col("n_valid") == 0)
    )
    if strict and not batches.isEmpty():
        raise ValueError("a formatting batch holds no valid text")
    return batches
