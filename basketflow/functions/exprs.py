"""Scalar column expressions (P9, P12, X1, X2 and friends); all stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the recency weights: decay rate of the exponential weight.
DECAY_ALPHA = 0.02
NONE_TOKEN = "None"


def ratio(num, den) -> Column:
    """num / den as double; NULL (not an error, not NaN) when den is 0 or NULL."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def day_weight(days_ago) -> Column:
    """The day weight 1 / (days_ago + 1) (P12) as a decimal: a sum of decimals is exact, so it does not
    depend on the order in which partitions add up, and has room for 10^20 purchases."""
    return (F.lit(1.0) / (F.col(days_ago).cast("double") + 1.0)).cast("decimal(28,18)")


def exp_weight(days_ago) -> Column:
    """exp(-alpha * days_ago) for any number of days (P12; no lookup table)."""
    return F.exp(F.lit(-DECAY_ALPHA) * F.col(days_ago).cast("double"))


def circular_hour_distance(h1, h2) -> Column:
    """Distance of two hours of day on the 24-hour circle."""
    d = F.abs(F.col(h1) - F.col(h2))
    return F.least(d, F.lit(24) - d)


def id_list_string(arr: Column) -> Column:
    """Space-joined ids of an array column."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), " ")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float/double column to ``digits`` places as round(x * 10^d) / 10^d (half away
    from zero): the same IEEE operations SQL engines use, so one double rounds alike everywhere."""
    scale = float(10 ** digits)
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((F.round(F.col(f.name).cast("double") * scale, 0) / scale).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
