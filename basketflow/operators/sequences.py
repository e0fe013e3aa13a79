"""Order-dependent scans that stay balanced when one key holds a large share of the rows.

A plain ``Window.partitionBy(key).orderBy(...)`` puts every row of a key into one task. Here
the ordering column is cut into contiguous blocks: the window runs inside (key, block) - at
most ``block_size`` rows - and a second window runs over one summary row per block, so a key
with a billion rows becomes many bounded partitions plus a short list of block summaries.
The big table is shuffled once, by (key, block); only block summaries move afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.sources.retail_view import dealt

# Rows of one key per block: a whole history of a typical user fits in block 0.
BLOCK_SIZE = 1024
_B = "_blk"


def _blocked(df: DataFrame, order_col: str, block_size: int) -> DataFrame:
    return df.withColumn(_B, F.floor(F.col(order_col) / F.lit(block_size)).cast("long"))


def running_sum(df: DataFrame, keys: list[str], order_col: str, value_col: str, out_col: str,
                total_col: str | None = None, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over the key's rows up to this one (by ``order_col``),
    NULLs skipped (NULL while no value has been seen); optionally ``total_col`` = the key's total."""
    x = _blocked(df, order_col, block_size)
    inner = Window.partitionBy(*keys, _B).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_in", F.sum(value_col).over(inner))
    blocks = x.groupBy(*keys, _B).agg(F.sum(value_col).alias("_bt"))
    earlier = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.sum("_bt").over(earlier))
    cols = [*keys, _B, "_off"]
    if total_col:
        blocks = blocks.withColumn(total_col, F.sum("_bt").over(Window.partitionBy(*keys)))
        cols.append(total_col)
    x = x.join(blocks.select(*cols), [*keys, _B])
    run = F.when(F.col("_in").isNull() & F.col("_off").isNull(), F.lit(None)).otherwise(
        F.coalesce("_off", F.lit(0)) + F.coalesce("_in", F.lit(0)))
    return x.withColumn(out_col, run).drop(_B, "_in", "_off")


def lag(df: DataFrame, keys: list[str], order_col: str, value_col: str, out_col: str,
        block_size: int = BLOCK_SIZE, parts: int = 0) -> DataFrame:
    """Add ``out_col`` = ``value_col`` of the key's previous row by ``order_col`` (NULL on the first).

    Rows and blocks are dealt out in ``parts`` partitions (0: the session's)."""
    x = dealt(_blocked(df, order_col, block_size), parts, *keys, _B)
    inner = Window.partitionBy(*keys, _B).orderBy(order_col)
    x = x.withColumn("_lag", F.lag(value_col).over(inner)).withColumn("_first", F.row_number().over(inner) == 1)
    blocks = dealt(x.groupBy(*keys, _B).agg(F.max_by(value_col, order_col).alias("_last")), parts, *keys)
    blocks = blocks.withColumn("_prev", F.lag("_last").over(Window.partitionBy(*keys).orderBy(_B)))
    x = x.join(blocks.select(*keys, _B, "_prev"), [*keys, _B])
    return (x.withColumn(out_col, F.when(F.col("_first"), F.col("_prev")).otherwise(F.col("_lag")))
            .drop(_B, "_lag", "_first", "_prev"))


def median_small_domain(df: DataFrame, keys: list[str], value_col: str, out_col: str) -> DataFrame:
    """Exact (interpolating) median of an integer ``value_col`` per key, via a per-key histogram.

    Spark's ``median`` keeps every value of a group in one buffer; counting per (key, value)
    first is a partial aggregation, and the window then runs over the distinct values of a key
    only (basket sizes: bounded by the largest basket). NULL values are skipped.
    """
    hist = (df.where(F.col(value_col).isNotNull())
            .groupBy(*keys, value_col).agg(F.count(F.lit(1)).alias("_c")))
    hist = (hist.withColumn("_cum", F.sum("_c").over(
                Window.partitionBy(*keys).orderBy(value_col).rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys))))
    lo = F.floor((F.col("_n") - 1) / 2)
    hi = F.floor(F.col("_n") / 2)

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_cum") > rank, F.col(value_col)))

    return hist.groupBy(*keys).agg(((at(lo) + at(hi)) / 2.0).cast("double").alias(out_col))
