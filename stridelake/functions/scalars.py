"""Column functions on numbers and angles; nulls give null unless said otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def finite(x: Column | str) -> Column:
    """x, with NaN and infinities as null."""
    x = col(x).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < math.inf), x)


def clip(x: Column | str, low: float, high: float) -> Column:
    x = col(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def wrap_degrees(x: Column | str) -> Column:
    """The same angle in [-180, 180)."""
    return F.pmod(col(x) + 180.0, F.lit(360.0)) - 180.0


def wrap_step(d: Column | str) -> Column:
    """A difference of angles in [-180, 180), but 180 where a positive one would become -180."""
    d = col(d)
    wrapped = wrap_degrees(d)
    return F.when((wrapped == -180.0) & (d > 0), F.lit(180.0)).otherwise(wrapped)


def seconds_to_frames(seconds: Column | float, fps: Column | float, least: int = 1) -> Column:
    """Frames nearest to a duration, half to even, at least `least`; `least` where fps isn't positive."""
    seconds, fps = (x if isinstance(x, Column) else F.lit(float(x)) for x in (seconds, fps))
    frames = F.greatest(F.bround(seconds * fps).cast("int"), F.lit(least))
    return F.when(fps > 0, frames).otherwise(F.lit(least))


def frames_of(seconds: float, fps: float, least: int = 1) -> int:
    """seconds_to_frames for plain numbers."""
    return max(round(seconds * fps), least) if fps > 0 else least


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(col(a), col(b))


def normalized_asymmetry(left: Column | str, right: Column | str, least: float = 1e-6) -> Column:
    """|l - r| in percent of the mean magnitude of the two."""
    left, right = col(left), col(right)
    return F.abs(left - right) / F.greatest((F.abs(left) + F.abs(right)) / 2, F.lit(least)) * 100


def mean_of_known(*values: Column | str) -> Column:
    """Mean of those that aren't null; null if all are."""
    parts = [col(v) for v in values]
    total = sum((F.coalesce(v, F.lit(0.0)) for v in parts), F.lit(0.0))
    n = sum((v.isNotNull().cast("double") for v in parts), F.lit(0.0))
    return safe_divide(total, n)


def binned(value: Column | str, edges: list[float], labels: list[str], closed: tuple[int, ...] = ()) -> Column:
    """labels[k] for the first edge that value lies below (or at, for edges listed in closed); the last label beyond all."""
    value = col(value)
    out = None
    for k, edge in enumerate(edges):
        test = value <= edge if k in closed else value < edge
        out = F.when(test, labels[k]) if out is None else out.when(test, labels[k])
    return F.when(value.isNotNull(), out.otherwise(labels[-1]))
