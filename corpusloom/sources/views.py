"""Input views over the given tables, the shapes the operators expect.

Every view keeps the whole table. Where a query is about faulty rows, such as blank texts or
broken JSON, its view adds them under ids of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import SpecialTokens
from corpusloom.operators.positions import ordinals
from corpusloom.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "lang", "source", "text")


def dirty_texts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, and under new ids rows with a null, an empty or a blank text."""
    documents = raw_texts(spark, folder)
    case, number = F.col("doc_id") % 11, F.col("doc_id")
    faulty = (
        F.when(case == 0, F.lit(None).cast("string"))
        .when(case == 1, F.lit(""))
        .when((case == 2) | number.between(200, 399), F.lit("   "))
        .when(case == 3, F.lit("\u00a0\u3000\t"))
        .otherwise(F.lit("\u200b"))
    )
    chosen = documents.filter((case <= 4) | number.between(200, 399))
    extra = chosen.withColumns({"text": faulty, "doc_id": -F.col("doc_id") - 1})
    return documents.unionByName(extra)


def json_texts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as JSON objects, and under new ids malformed ones or without a string."""
    documents = raw_texts(spark, folder)
    case = F.col("doc_id") % 5
    faulty = (
        F.when(case == 0, F.concat(F.lit("{"), F.col("text")))
        .when(case == 1, F.lit('{"content": 5}'))
        .when(case == 2, F.to_json(F.struct(F.col("text").alias("other"))))
        .otherwise(F.lit('{"content": null}'))
    )
    whole = documents.withColumn("text", F.to_json(F.struct(F.col("text").alias("content"))))
    extra = documents.filter(case <= 3).withColumns(
        {"text": faulty, "doc_id": -F.col("doc_id") - 1}
    )
    return whole.unionByName(extra)


def chat_texts(
    spark: SparkSession, folder: str, tokens: SpecialTokens = SpecialTokens()
) -> DataFrame:
    """One marked text per conversation (conv_id, text).

    A conversation is one text, however many turns it has. A system turn becomes the head of
    the turn after it.
    """
    role = F.col("role")
    piece = F.when(role == "system", F.concat("text", F.lit("\n"))).otherwise(
        F.concat(
            F.when(role == "user", tokens.user_marker).otherwise(tokens.bot_marker),
            F.col("text"),
            F.lit(tokens.end_marker),
        )
    )
    turns = F.sort_array(F.collect_list(F.struct("turn", piece.alias("piece"))))
    return (
        table(spark, folder, "conversations")
        .groupBy("conv_id")
        .agg(turns.alias("turns"))
        .select("conv_id", F.array_join(F.col("turns.piece"), "").alias("text"))
    )


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as arrays of (role, content), system turns kept."""
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    return (
        table(spark, folder, "conversations")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(
            "conv_id",
            F.transform(
                "turns",
                lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")),
            ).alias("conversation"),
        )
    )


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a metrics log: one run per user, one micro-batch per event, in time order.

    The log is written once as a table, as the loop of a training run would have done.
    """
    loss = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    log = table(spark, folder, "events").select(
        F.col("user_id").alias("run_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
        "event_id",
        loss.alias("loss"),
    )
    path = scratch_path(spark, "metrics")
    ordinals(log, ["ts_us", "event_id"], "micro", by=["run_id"]).select(
        "run_id", "micro", "ts_us", "loss"
    ).write.parquet(path)
    return spark.read.parquet(path)


def failure_log(spark: SparkSession, folder: str) -> DataFrame:
    """Error events as log messages, worded by the number in their properties."""
    number = F.get_json_object("props", "$.k").cast("int")
    message = (
        F.when(number < 20, "Connection RESET by peer")
        .when(number < 35, "Read Timeout after 30s")
        .when(number < 50, "429: too many Requests")
        .when(number < 60, "Broken pipe")
        .when(number < 80, "value error in row")
        .otherwise("loss diverged")
    )
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "error")
        .select(F.col("user_id").alias("run_id"), message.alias("message"))
    )
