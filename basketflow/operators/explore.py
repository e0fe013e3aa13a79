"""Exploration tables (A19-A27, P6, P11, O2-O4, J12): the tables behind the notebook's charts.

All are grouped counts or means with map-side partial aggregation; the top-k reports end in a
TakeOrderedAndProject (a bounded per-partition top-k, then one small merge) with an explicit
tie-break so their rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.exprs import ratio
from basketflow.sources.retail_view import dealt

# Fixed values of the notebook: histogram cut-off, cart-position clip, support threshold,
# report lengths.
HISTORY_TOP = 80
CART_CLIP = 60
MIN_SUPPORT = 100
TOP_NAMES = 20
TOP_RATES = 10


def eval_set_counts(orders: DataFrame) -> DataFrame:
    """Orders per eval_set, with the distinct users of each set."""
    return orders.groupBy("eval_set").agg(F.count(F.lit(1)).alias("n_orders"),
                                          F.count_distinct("user_id").alias("n_users"))


def distinct_entities(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Scale of the data set, one row: an aggregate per table (one distinct count each, so no
    row is expanded), the second as a scalar."""
    n_products = products.agg(F.count_distinct("product_id")).scalar()
    return (orders.agg(F.count(F.lit(1)).alias("n_orders"), F.count_distinct("user_id").alias("n_users"))
            .select("n_orders", "n_users", n_products.alias("n_products")))


def history_histogram(orders: DataFrame, top: int = HISTORY_TOP) -> DataFrame:
    """Users per history length (max order_number), most frequent first, first ``top``;
    ``avg_history_len`` is the mean over all users."""
    per_user = orders.groupBy("user_id").agg(F.max("order_number").alias("history_len"))
    hist = per_user.groupBy("history_len").agg(F.count(F.lit(1)).alias("n_users"))
    mean = hist.agg(F.sum(F.col("history_len") * F.col("n_users")) / F.sum("n_users")).scalar()
    hist = hist.select("history_len", "n_users", mean.alias("avg_history_len"))
    return hist.orderBy(F.col("n_users").desc(), F.col("history_len")).limit(top)


def basket_histogram(lines: DataFrame, parts: int = 0) -> DataFrame:
    """Orders per basket size (max add_to_cart_order), with the mean basket size; the lines meet in ``parts``
    partitions (0: the session's)."""
    per_order = dealt(lines, parts, "order_id").groupBy("order_id").agg(F.max("add_to_cart_order").alias("basket_size"))
    hist = per_order.groupBy("basket_size").agg(F.count(F.lit(1)).alias("n_orders"))
    mean = hist.agg(F.sum(F.col("basket_size") * F.col("n_orders")) / F.sum("n_orders")).scalar()
    return hist.select("basket_size", "n_orders", mean.alias("avg_basket_size"))


def orders_by(orders: DataFrame, column: str) -> DataFrame:
    """Order counts per value of ``column`` (NULL values are not counted, as in a count plot)."""
    return (orders.where(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_orders")))


def reorder_by_dow_hour(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean reordered flag per (order_dow, order_hour_of_day) of the lines' orders."""
    x = lines.select("order_id", "reordered").join(
        orders.select("order_id", "order_dow", "order_hour_of_day"), "order_id", "left")
    return x.groupBy("order_dow", "order_hour_of_day").agg(F.avg("reordered").alias("reorder_ratio"))


def reorder_pivot(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """A24 as a day-of-week x hour matrix, columns h0..h23."""
    x = lines.select("order_id", "reordered").join(
        orders.select("order_id", "order_dow", "order_hour_of_day"), "order_id", "left")
    p = x.groupBy("order_dow").pivot("order_hour_of_day", list(range(24))).agg(F.avg("reordered"))
    return p.select("order_dow", *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


def top_products(lines: DataFrame, products: DataFrame, top: int = TOP_NAMES) -> DataFrame:
    """The ``top`` product names by number of lines (ties by name)."""
    counts = lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("frequency_count"))
    named = counts.join(products.select("product_id", "product_name"), "product_id", "left")
    by_name = named.groupBy("product_name").agg(F.sum("frequency_count").alias("frequency_count"))
    return by_name.orderBy(F.col("frequency_count").desc(), F.col("product_name")).limit(top)


def product_reorder_rates(lines: DataFrame, orders: DataFrame, products: DataFrame,
                          min_support: int = MIN_SUPPORT) -> DataFrame:
    """A1 + P9 + P6 + J12: products with more than ``min_support`` lines and their reorder rate."""
    x = lines.select("order_id", "product_id", "reordered").join(
        orders.select("order_id"), "order_id")  # J4: lines of known orders
    stats = x.groupBy("product_id").agg(F.sum("reordered").alias("reordered"),
                                        F.count(F.lit(1)).alias("order_cnt"))
    stats = stats.where(F.col("order_cnt") > min_support).withColumn(
        "reorder_rate", ratio("reordered", "order_cnt"))
    return stats.join(products.select("product_id", "product_name"), "product_id", "left")


def reorder_rate_top(rates: DataFrame, top: int = TOP_RATES) -> DataFrame:
    """O2 / O3: highest reorder rates (ties by product_id)."""
    return rates.orderBy(F.col("reorder_rate").desc(), F.col("product_id")).limit(top)


def reorder_rate_bottom(rates: DataFrame, top: int = TOP_RATES) -> DataFrame:
    """O3: the last ``top`` rows of the descending ranking."""
    return rates.orderBy(F.col("reorder_rate").asc(), F.col("product_id").desc()).limit(top)


def reorder_by_cart_position(lines: DataFrame, clip: int = CART_CLIP) -> DataFrame:
    """P11 + A26: mean reordered flag per cart position, positions above ``clip`` folded into it."""
    return (lines.groupBy(F.least(F.col("add_to_cart_order"), F.lit(clip)).alias("add_to_cart_order_mod"))
            .agg(F.avg("reordered").alias("reorder_ratio")))
