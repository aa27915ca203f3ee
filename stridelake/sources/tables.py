"""Reading raw sequences and writing stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions.strings import first_known
from stridelake.operators.tables import upsert
from stridelake.sources.contracts import first_failure

POSE, JOINT_COUNT, BETAS = 72, 24, 10


def read_stage(spark: SparkSession, path: str, subset: str | None = None) -> DataFrame:
    """A stage table partitioned by subset; a subset prunes its partitions."""
    df = spark.read.parquet(path)
    return df if subset is None else df.where(F.col("subset") == subset)


def write_stage(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy("subset").parquet(path)


def write_rows(df: DataFrame, path: str, kind: str = "json") -> None:
    """Rows as JSON lines or as CSV with a header; NaN and infinities become null first."""
    numbers = [f.name for f in df.schema if f.dataType.simpleString() in ("double", "float")]
    clean = df.withColumns({n: F.when(F.abs(n) < float("inf"), F.col(n)) for n in numbers}) if numbers else df
    writer = clean.write.mode("overwrite")
    writer.json(path) if kind == "json" else writer.csv(path, header=True)


def merge_summary(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("subset", "subject_id", "trial_id")) -> DataFrame:
    return upsert(old, new, list(keys)).orderBy(*keys)


def flatten_dataset(nested: DataFrame) -> DataFrame:
    """nested(subset, sequences map<subject, map<trial, struct>>) -> one row per sequence."""
    subjects = nested.select("subset", F.explode("sequences").alias("subject_id", "_trials"))
    return subjects.select("subset", "subject_id", F.explode("_trials").alias("trial_id", "payload")).select(
        "subset", "subject_id", "trial_id", "payload.*"
    )


def with_identity(flat: DataFrame, stem: str) -> DataFrame:
    """Flat single sequences: identity from the aliases present, else the file's stem, trial_0001 and single_sequence."""
    found = lambda names: [n for n in names if n in flat.columns]
    subject = found(["subject_id", "subject", "sequence_id", "name"])
    trial, subset = found(["trial_id", "trial"]), found(["subset", "subset_name", "dataset"])
    pick = lambda names, other: F.coalesce(first_known(*names), F.lit(other)) if names else F.lit(other)
    return flat.withColumns(
        {"subject_id": pick(subject, stem), "trial_id": pick(trial, "trial_0001"), "subset": pick(subset, "single_sequence")}
    )


def validate_raw(raw: DataFrame) -> DataFrame:
    """raw sequences (pose, trans, beta arrays, fps) with `reason`: the first rule that each breaks, else ok.

    pose and trans hold one array per frame; beta holds 10 numbers, or one array of
    10 per frame as long as they agree to 1e-5.
    """
    finite = lambda column: F.forall(column, lambda row: F.forall(row, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    frames = F.size("pose")
    first = F.get("beta", 0)
    steady = F.forall(
        "beta",
        lambda row: F.forall(F.arrays_zip(row.alias("a"), first.alias("b")), lambda p: F.abs(p["a"] - p["b"]) <= 1e-5 + 1e-5 * F.abs(p["b"])),
    )
    rules = [
        ("missing keys", F.col("pose").isNull() | F.col("trans").isNull() | F.col("beta").isNull() | F.col("fps").isNull()),
        ("pose must have shape (T, 72)", F.exists("pose", lambda r: F.size(r) != POSE)),
        ("trans must have shape (T, 3)", F.exists("trans", lambda r: F.size(r) != 3)),
        ("pose and trans differ in length", frames != F.size("trans")),
        ("no frames", frames <= 0),
        ("pose or trans is not finite", ~(finite("pose") & finite("trans"))),
        ("beta must have shape (10,), (1, 10) or (T, 10)", F.exists("beta", lambda r: F.size(r) != BETAS) | ~F.size("beta").isin(1) & (F.size("beta") != frames)),
        ("beta is not constant", ~steady),
        ("fps must be positive", ~(F.col("fps") > 0)),
    ]
    return raw.withColumn("reason", first_failure(rules))


def skip_short(df: DataFrame, least_sec: float = 3.0) -> DataFrame:
    """Valid sequences shorter than the least duration get the reason duration_lt_<n>s."""
    short = F.try_divide(F.size("pose").cast("double"), F.col("fps")) < least_sec
    return df.withColumn("reason", F.when((F.col("reason") == "ok") & short, f"duration_lt_{least_sec:g}s").otherwise(F.col("reason")))
