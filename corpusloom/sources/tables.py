"""Readers and writers of the raw and the prepared dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.prepare import KEPT, REJECTED
from corpusloom.sources import snapshots

PRETRAIN, INSTRUCT = "pretrain", "instruct"


@dataclass(frozen=True)
class DatasetPaths:
    """Parquet locations of the two raw datasets; each has a text column."""

    pretrain: str
    instruct: str


def scan(spark: SparkSession, paths: DatasetPaths, instruct: bool, *keys: str) -> DataFrame:
    """The raw dataset of a phase, pruned to its text and the wanted key columns."""
    path = paths.instruct if instruct else paths.pretrain
    return spark.read.parquet(path).select(*keys, "text")


def needs_training(instruct: bool, resume: bool, tokenizer_override: str | None) -> bool:
    """A tokenizer is trained only on a fresh pretraining run without a given tokenizer."""
    return not (instruct or resume or tokenizer_override)


def scan_corpus(spark: SparkSession, paths: DatasetPaths) -> DataFrame:
    """Texts for tokenizer training: always the pretraining dataset, whatever the phase."""
    return scan(spark, paths, False)


def _phase_base(path: str, phase: str) -> str:
    return f"{path}/phase={phase}"


def stage_prepared(df: DataFrame, path: str) -> str:
    """Write rows (phase, text, .., and maybe status) to be looked at before they are published.

    Rows keep their key columns, which carry the input order. Nothing is shuffled.
    """
    staged = snapshots.staging_path(path)
    if "status" not in df.columns:
        df = df.withColumn("status", F.lit(KEPT))
    df.write.partitionBy("phase", "status").parquet(staged)
    return staged


def publish_prepared(spark: SparkSession, staged: str, path: str) -> None:
    """Make staged rows the newest version of their phases, each phase as a whole."""
    for name in snapshots.folders(spark, staged):
        base = f"{path}/{name}"
        while not snapshots.publish(
            spark, f"{staged}/{name}", base, max(snapshots.versions(spark, base), default=-1) + 1
        ):
            pass


def write_prepared(df: DataFrame, path: str) -> None:
    """Write prepared texts as Parquet, a version for each phase that the rows hold.

    Other phases stay as they are, and so does every phase where the write dies.
    """
    publish_prepared(df.sparkSession, stage_prepared(df, path), path)


def _read_phases(spark: SparkSession, path: str, phase: str | None, status: str) -> DataFrame:
    phases = [phase] if phase else [
        name.removeprefix("phase=") for name in snapshots.folders(spark, path) if name.startswith("phase=")
    ]
    out = None
    for name in phases:
        folder = snapshots.newest(spark, _phase_base(path, name))
        if folder is None:
            raise FileNotFoundError(f"no prepared rows of {name} below {path}")
        rows = spark.read.parquet(folder).filter(F.col("status") == status).drop("status")
        rows = rows.withColumn("phase", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no prepared rows below {path}")
    return out


def read_prepared(spark: SparkSession, path: str, phase: str | None = None) -> DataFrame:
    """The newest prepared rows of a phase, or of all phases."""
    return _read_phases(spark, path, phase, KEPT).drop("reject_reason", "error")


def read_rejected(spark: SparkSession, path: str, phase: str | None = None) -> DataFrame:
    """The rows that the same preparation rejected: raw text, reject_reason and error."""
    return _read_phases(spark, path, phase, REJECTED)


def prepared_report(prepared: DataFrame, *group: str) -> DataFrame:
    """Number of examples and characters of a prepared dataset, per group."""
    return prepared.groupBy(*group).agg(
        F.count("*").alias("n_examples"),
        F.sum(F.length("text").cast("bigint")).alias("n_chars"),
        F.max(F.length("text").cast("bigint")).alias("longest"),
    )


def run_report(prepared: DataFrame, vocab: DataFrame) -> DataFrame:
    """What a run starts with: examples and characters of each phase, and the vocabulary's size."""
    size = vocab.agg(F.count("*").alias("vocab_size")).scalar()
    return prepared_report(prepared, "phase").withColumn("vocab_size", size)
