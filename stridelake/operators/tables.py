"""Whole-table operations: upsert, skipping what exists, limits and validation of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridelake.functions.strings import sequence_stem


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new in place of those with the same keys; columns are united, missing ones null."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def skip_existing(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def first_per_group(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def select_sequences(
    df: DataFrame,
    subset: str = "subset",
    subject: str = "subject_id",
    trial: str = "trial_id",
    subsets: list[str] | None = None,
    subjects: list[str] | None = None,
    trials: list[str] | None = None,
    trial_contains: str | None = None,
    ignore_case: bool = True,
    stem_contains: str | None = None,
) -> DataFrame:
    """Rows whose identity matches every filter given; ids are compared as strings.

    trial_contains looks at the trial alone, stem_contains, without regard to case,
    at the whole name of the sequence, as later stages do.
    """
    for column, wanted in ((subset, subsets), (subject, subjects), (trial, trials)):
        if wanted is not None:
            df = df.where(F.col(column).cast("string").isin([str(w) for w in wanted]))
    if trial_contains:
        text, part = F.col(trial).cast("string"), trial_contains
        df = df.where(F.contains(F.lower(text), F.lit(part.lower())) if ignore_case else F.contains(text, F.lit(part)))
    if stem_contains:
        df = df.where(F.contains(F.lower(sequence_stem(subset, subject, trial)), F.lit(stem_contains.lower())))
    return df
