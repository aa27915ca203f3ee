"""Schema contracts and validity rules of the stage tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_failure(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that a row breaks (its test is true), else `ok`; unknown tests don't break."""
    out = None
    for name, broken in rules:
        broken = F.coalesce(broken, F.lit(False))
        out = F.when(broken, name) if out is None else out.when(broken, name)
    return out.otherwise("ok") if out is not None else F.lit("ok")


def require_columns(df: DataFrame, needed: list[str], exactly: bool = False) -> DataFrame:
    """df, if it has the columns (and, if asked, no others); a ValueError that names them otherwise."""
    missing = sorted(set(needed) - set(df.columns))
    more = sorted(set(df.columns) - set(needed)) if exactly else []
    if missing or more:
        raise ValueError(f"missing columns {missing}, unexpected columns {more}")
    return df


def segments_cover(segments: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Per sequence whether closed intervals start at 0 and follow each other without gap or overlap, and the last frame."""
    window = Window.partitionBy(*keys).orderBy(start)
    before = F.lag(end).over(window)
    df = segments.withColumn("_joined", before.isNull() | (before + 1 == F.col(start)))
    return df.groupBy(*keys).agg(
        ((F.min(start) == 0) & F.bool_and("_joined")).alias("covers"), F.max(end).cast("int").alias("last_frame")
    )


def quarantine(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Rows whose reason is `ok`, and the others."""
    good = F.col(reason) == "ok"
    return df.where(good), df.where(~good | F.col(reason).isNull())
