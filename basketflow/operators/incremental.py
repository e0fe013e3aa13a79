"""Mergeable statistics: what one load of orders contributes is stored, and a new load adds to it.

*Moments.* A state holds n, mean and the central sums M2, M3, M4 of a value by key. Spark's own aggregates give them in
one stable pass; merging any number of states is one aggregate over the states around their common mean (Chan, Golub
and LeVeque, 1983; Pebay, 2008), so the merged state equals that of all rows but for rounding.

*Gaps.* The gaps between a pair's purchases need the pair's last purchase before the load. It is kept as one row per
pair, on the scale of days since the user's first order, which later loads do not move. The gaps of a load are a blocked
lag inside it, and the first purchase of each pair in it meets the stored last one.

*Distinct counts.* HLL sketches by key, stored as binary, merged by union: loads may overlap, and an estimate is off by
1.04 / sqrt(2^lg_k) of the count (one standard error); small sets are exact.

All tables have one row per key, come from map-side combined aggregates and are plain Parquet when staged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.operators import sequences as seq
from basketflow.sources.retail_view import dealt

LG_K = 12


# ---------------------------------------------------------------- moments

def moment_state(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, mean, m2, m3, m4) of ``value`` by key; NULLs are left out, a key with no value has no row."""
    v = F.col(value).cast("double")
    base = rows.where(v.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("_var"), F.skewness(v).alias("_skew"), F.kurtosis(v).alias("_kurt"))
    # Without variance skewness and kurtosis are NULL and the sums are 0.
    return base.select(*keys, "n", "mean", (F.col("_var") * F.col("n")).alias("m2"),
                       F.coalesce(F.col("_skew") * F.pow("_var", F.lit(1.5)) * F.col("n"), F.lit(0.0)).alias("m3"),
                       F.coalesce((F.col("_kurt") + 3.0) * F.col("_var") * F.col("_var") * F.col("n"), F.lit(0.0)).alias("m4"))


def merge_moments(states: list[DataFrame], keys: list[str]) -> DataFrame:
    """One state per key from any number of state tables."""
    rows = reduce(DataFrame.unionByName, states)
    common = rows.groupBy(*keys).agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    d, n = F.col("mean") - F.col("_mean"), F.col("n")
    return rows.join(common, keys).groupBy(*keys).agg(
        F.first("_n").alias("n"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + n * d * d).alias("m2"),
        F.sum(F.col("m3") + 3 * d * F.col("m2") + n * d * d * d).alias("m3"),
        F.sum(F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2") + n * d * d * d * d).alias("m4"))


def finish_moments(state: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Mean, population standard deviation, skewness and excess kurtosis; the last two are NULL without variance."""
    var = F.col("m2") / F.col("n")
    # Rounding may leave a trace of variance where all values are equal.
    flat = F.col("m2") <= F.col("n") * F.lit(1e-18) * F.greatest(F.lit(1.0), F.col("mean") * F.col("mean"))
    return state.select(
        *keys, F.col("mean").alias(f"{prefix}_mean"), F.when(flat, 0.0).otherwise(F.sqrt(var)).alias(f"{prefix}_std"),
        F.when(~flat, F.col("m3") / F.col("n") / F.pow(var, F.lit(1.5))).alias(f"{prefix}_skew"),
        F.when(~flat, F.col("m4") / F.col("n") / (var * var) - 3.0).alias(f"{prefix}_kurtosis"))


# ---------------------------------------------------------------- gaps over loads

def elapsed_days(orders: DataFrame) -> DataFrame:
    """(order_id, elapsed): days since the user's first order, which later orders do not change."""
    x = seq.running_sum(orders.select("order_id", "user_id", "order_number", "days_since_prior_order"), ["user_id"], "order_number",
                        "days_since_prior_order", "_cum")
    missing = F.col("days_since_prior_order").isNull()
    return x.select("order_id", F.when(missing, 0.0).otherwise(F.col("_cum")).cast("int").alias("elapsed"))


def load_gaps(lines: DataFrame, last: DataFrame | None = None, parts: int = 0) -> DataFrame:
    """(user_id, product_id, gap): the gaps that a load adds, from lines (user_id, product_id, order_number, elapsed).

    ``last`` (from ``last_purchases``) is each pair's last purchase before the load; without it the load is the first. Rows
    are dealt out in ``parts`` partitions (0: the session's).
    """
    pair = ["user_id", "product_id"]
    x = seq.lag(lines.select("user_id", "product_id", "order_number", "elapsed"), pair, "order_number", "elapsed", "_before", parts=parts)
    if last is not None:
        x = dealt(x, parts, *pair).join(dealt(last, parts, *pair), pair, "left").withColumn("_before", F.coalesce("_before", "last_elapsed"))
    return x.select("user_id", "product_id", (F.col("elapsed") - F.col("_before")).alias("gap")).where("gap is not null")


def last_purchases(lines: DataFrame, before: DataFrame | None = None, parts: int = 0) -> DataFrame:
    """(user_id, product_id, last_order, last_elapsed) after the load: each pair's newest purchase; rows are dealt out in
    ``parts`` partitions (0: the session's)."""
    now = lines.select("user_id", "product_id", F.col("order_number").alias("last_order"), F.col("elapsed").alias("last_elapsed"))
    rows = now if before is None else now.unionByName(before)
    return dealt(rows, parts, "user_id", "product_id").groupBy("user_id", "product_id").agg(F.max("last_order").alias("last_order"), F.max_by("last_elapsed", "last_order").alias("last_elapsed"))


# ---------------------------------------------------------------- distinct counts

def distinct_sketch(rows: DataFrame, keys: list[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """(keys, sketch): an HLL sketch of the distinct values by key."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.hll_sketch_agg(F.col(value).cast("string"), F.lit(lg_k)).alias("sketch"))


def merge_sketches(states: list[DataFrame], keys: list[str]) -> DataFrame:
    """The sketch of the union by key."""
    return reduce(DataFrame.unionByName, states).groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(state: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, estimate)."""
    return state.select(*keys, F.hll_sketch_estimate("sketch").alias("estimate"))


def standard_error(lg_k: int = LG_K) -> float:
    """Of an estimate, as a share of the count."""
    return 1.04 / 2 ** (lg_k / 2)
