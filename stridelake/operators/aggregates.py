"""Aggregate columns and grouped fits; nulls are left out unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.functions.scalars import finite


def robust_range(value: str | Column, low: float = 0.05, high: float = 0.95) -> Column:
    """Distance between two percentiles with linear interpolation."""
    value = finite(value)
    both = F.percentile(value, [low, high])
    return both[1] - both[0]


def cv_percent(value: str | Column) -> Column:
    """Population standard deviation in percent of the mean's magnitude; null for a mean near zero."""
    value = finite(value)
    mean = F.abs(F.avg(value))
    return F.when(mean >= 1e-8, F.try_divide(F.stddev_pop(value), mean) * 100)


def weighted_mean(value: str | Column, weight: str | Column) -> Column:
    """Weighted mean over rows where both are finite, the plain mean where the weights sum to 0 or less."""
    value, weight = finite(value), finite(weight)
    both = value.isNotNull() & weight.isNotNull()
    total = F.sum(F.when(both, weight))
    plain = F.avg(F.when(both, value))
    return F.when(total > 0, F.try_divide(F.sum(F.when(both, value * weight)), total)).otherwise(plain)


def detrended_std(value: str, order: str) -> Column:
    """Population standard deviation around the line between the first and the last value; null for fewer than two rows.

    Sums over the rows suffice, since the line is linear in the rank of a row:
    order must count up by one within a group.
    """
    n = F.count(F.lit(1))
    i = F.col(order).cast("double") - 0.0
    y = F.col(value)
    first, last = F.min_by(value, order), F.max_by(value, order)
    slope = F.try_divide(last - first, (n - 1).cast("double"))
    variance = F.var_pop(y) - 2 * slope * F.covar_pop(y, i) + slope * slope * F.var_pop(i)
    return F.when(n >= 2, F.sqrt(F.greatest(variance, F.lit(0.0))))


def double_support_score(left: str, right: str) -> tuple[Column, Column]:
    """How close each foot's share of contact is to 0.6, from 0 to 1."""

    def score(mask: str) -> Column:
        duty = F.avg(F.col(mask).cast("double"))
        return F.greatest(F.lit(0.0), 1 - F.least(F.abs(duty - 0.6) / 0.6, F.lit(1.0)))

    return score(left), score(right)


def percentile_rank(
    values: DataFrame, reference: DataFrame, metrics: list[str], keys: list[str], inverted: tuple[str, ...] = (), parts: int = 64
) -> DataFrame:
    """values with a column <metric>_rank: the share of reference values at or below it, 1 less that for inverted ones.

    `keys` name a row of values. Counts per distinct value are dealt to about
    `parts` ranges of a metric, whose bounds are quantiles of the values of least
    hash: the ranges are made twice, and bounds must not depend on the order in
    which rows come. A running sum goes over the ranges' totals, and one over the
    values of each range, so that no task sorts a whole metric. Null values rank
    null, as do all values of a metric without reference values.
    """

    def long(df: DataFrame, *more: str) -> DataFrame:
        pairs = F.map_from_arrays(F.array(*[F.lit(m) for m in metrics]), F.array(*[finite(m) for m in metrics]))
        return df.select(*more, F.explode(pairs).alias("metric", "v")).where("v IS NOT NULL")

    row = F.struct(*keys)
    asked = long(values.select(row.alias("_row"), *metrics), "_row").select("metric", "v", F.lit(0).cast("long").alias("n"), "_row")
    known = long(reference.select(*metrics)).groupBy("metric", "v").agg(F.count("*").alias("n"))
    # A row per metric, of `parts` numbers: small by its parameters.
    least = known.withColumn("_rank", F.row_number().over(Window.partitionBy("metric").orderBy(F.xxhash64("v"), "v"))).where(F.col("_rank") <= 15 * parts)
    cuts = least.groupBy("metric").agg(F.sort_array(F.collect_list("v")).alias("_some"))
    share = lambda k: F.element_at("_some", (F.floor(k * F.size("_some") / parts) + 1).cast("int"))
    cuts = cuts.select("metric", F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), share).alias("_cuts"))
    known = known.select("metric", "v", "n", F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"))
    dealt = asked.union(known).join(F.broadcast(cuts), "metric", "left")
    dealt = dealt.withColumn("_part", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("v"))), F.lit(0))).drop("_cuts")
    before = Window.partitionBy("metric").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("metric", "_part").agg(F.sum("n").alias("_held"))
    total = F.sum("_held").over(Window.partitionBy("metric"))
    bases = bases.select("metric", "_part", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_base"), total.alias("_total"))
    upto = Window.partitionBy("metric", "_part").orderBy("v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = dealt.withColumn("_upto", F.sum("n").over(upto)).where("_row IS NOT NULL").join(F.broadcast(bases), ["metric", "_part"])
    share = F.try_divide((F.col("_base") + F.col("_upto")).cast("double"), F.col("_total").cast("double"))
    flip = F.col("metric").isin(list(inverted)) if inverted else F.lit(False)
    ranked = ranked.withColumn("rank", F.when(flip, 1 - share).otherwise(share))
    wide = ranked.groupBy("_row").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("rank"))).alias(f"{m}_rank") for m in metrics]
    )
    return values.join(wide.select("_row.*", *[f"{m}_rank" for m in metrics]), keys, "left")


def plane_fit(x: str, y: str, z: str) -> tuple[Column, Column, Column, Column]:
    """a, b, c of the least-squares plane z = ax + by + c, and its determinant; null without a unique plane."""
    sxx, syy, sxy = F.var_pop(x), F.var_pop(y), F.covar_pop(x, y)
    sxz, syz = F.covar_pop(x, z), F.covar_pop(y, z)
    det = sxx * syy - sxy * sxy
    usable = det > 1e-12 * F.greatest(sxx * syy, F.lit(1e-300))
    a = F.when(usable, F.try_divide(sxz * syy - syz * sxy, det))
    b = F.when(usable, F.try_divide(syz * sxx - sxz * sxy, det))
    return a, b, F.avg(z) - a * F.avg(x) - b * F.avg(y), det


def principal_axis(x: str, y: str) -> tuple[Column, Column, Column]:
    """Direction (cos, sin) of the largest variance of points in a plane, and its share of the variance."""
    sxx, syy, sxy = F.var_samp(x), F.var_samp(y), F.covar_samp(x, y)
    half, gap = (sxx + syy) / 2, (sxx - syy) / 2
    root = F.sqrt(gap * gap + sxy * sxy)
    angle = 0.5 * F.atan2(2 * sxy, sxx - syy)
    return F.cos(angle), F.sin(angle), F.try_divide(half + root, sxx + syy)


def majority(value: str) -> Column:
    """The most frequent value, the smallest of equals."""
    return F.mode(value, deterministic=True)


def lowest_per_window(df: DataFrame, keys: list[str], order: str, value: str, stride: int, share: float) -> DataFrame:
    """Rows among the lowest ceil(share * n) of their block of `stride` rows, ties by order."""
    block = F.floor(F.col(order) / stride)
    df = df.withColumn("_block", block)
    group = Window.partitionBy(*keys, "_block")
    rank = F.row_number().over(group.orderBy(value, order))
    keep = F.ceil(F.count("*").over(group) * share)
    return df.withColumn("_rank", rank).withColumn("_keep", keep).where("_rank <= _keep").drop("_block", "_rank", "_keep")


def lowest_of(*points: tuple[str, Column]) -> Column:
    """Struct of value, place in the list and name of the smallest value; the first of equals."""
    return F.array_min(
        F.array(*[F.struct(v.alias("value"), F.lit(k).alias("place"), F.lit(n).alias("name")) for k, (n, v) in enumerate(points)])
    )
