"""Order, user, product and user x product features.

Inputs follow the reference layout: ``orders`` (order_id, user_id, eval_set, order_number,
order_dow, order_hour_of_day, days_since_prior_order), prior ``lines`` carrying user_id and
order_number (attach them with :func:`with_header` when a source has only the four line columns)
and ``products``.

Shuffle plan. Everything keyed by product goes through one pair-level pre-aggregation
(:func:`pair_counts`, keyed by (user_id, product_id), combined map-side) and is then reduced by
product from partial aggregates, so a product bought in a third of all lines never sends its raw
lines to one task. Order-dependent scans (running sum of gaps, lag between a pair's purchases)
are blocked scans (basketflow.operators.sequences): a user or pair with a huge history is cut
into bounded partitions. The streak window is cut to the last orders per user before any shuffle
(WindowGroupLimit); the median basket comes from a per-user histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions.exprs import (
    circular_hour_distance,
    exp_weight,
    ratio,
    day_weight,
)
from basketflow.operators import sequences as seq

# Recent orders kept for the streak (5 plus the target order).
STREAK_ORDERS = 5


def with_header(lines: DataFrame, orders: DataFrame, cols=("user_id", "order_number")) -> DataFrame:
    """Attach order-header columns to lines by order_id (left join; lines keep their rows)."""
    missing = [c for c in cols if c not in lines.columns]
    if not missing:
        return lines
    return lines.join(orders.select("order_id", *missing), "order_id", "left")


# ---------------------------------------------------------------- orders

def days_ago(orders: DataFrame) -> DataFrame:
    """W1 + W2 + P10: days between each order and the user's last order.

    cum = running sum of days_since_prior_order over the user's orders (NULLs skipped), set to 0
    on a row whose own gap is NULL; days_ago_since_last = max(cum) - cum, truncated to int.
    Gaps are never negative, so max(cum) is the user's total. The running sum is blocked
    (basketflow.operators.sequences),
    so a user with a huge history is not one task.
    """
    o = seq.running_sum(orders, ["user_id"], "order_number", "days_since_prior_order", "_run", total_col="_tot")
    cum = F.when(F.col("days_since_prior_order").isNull(), F.lit(0.0)).otherwise(F.col("_run"))
    return (o.withColumn("days_ago_since_last", (F.coalesce("_tot", F.lit(0.0)) - cum).cast("int"))
            .drop("_run", "_tot"))


def days_since_ratio(orders: DataFrame, users: DataFrame) -> DataFrame:
    """D1 + P9: days_since_prior_order / the user's mean gap (users computed first)."""
    u = users.select("user_id", "user_average_days_between_orders")
    return (orders.join(u, "user_id", "left")
            .withColumn("days_since_ratio",
                        ratio("days_since_prior_order", "user_average_days_between_orders"))
            .drop("user_average_days_between_orders"))


# ---------------------------------------------------------------- shared pair pre-aggregation

def pair_counts(lines: DataFrame) -> DataFrame:
    """Per (user, product): lines, reorders, lines after the first order, summed cart position.

    The one pre-aggregation that user and product features derive their counts from, so no
    count_distinct expands rows and no product key sees raw lines.
    """
    return lines.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("reordered").alias("r"),
        F.count_if(F.col("order_number") > 1).alias("nf"),
        F.sum("add_to_cart_order").alias("pos"),
    )


# ---------------------------------------------------------------- users

def user_features(orders: DataFrame, lines: DataFrame, products: DataFrame,
                  pairs: DataFrame | None = None) -> DataFrame:
    """One row per user with an order; line-based columns NULL for users without prior lines.

    The median basket comes from a histogram per user, whatever the length of the history.
    """
    pairs = pairs if pairs is not None else pair_counts(lines)
    by_orders = orders.groupBy("user_id").agg(
        F.avg("days_since_prior_order").alias("user_average_days_between_orders"),
        F.count(F.lit(1)).alias("user_total_orders"),
        F.sum("days_since_prior_order").alias("user_period"),
    )
    # Aisles and departments come from a catalogue-bounded dimension; their distinct counts are
    # sets bounded by the number of aisles / departments, so one aggregate covers everything.
    attrs = products.select("product_id", "aisle_id", "department_id")
    by_pairs = pairs.join(attrs, "product_id", "left").groupBy("user_id").agg(
        F.sum("n").alias("user_total_items"),
        F.count(F.lit(1)).alias("total_distinct_items"),
        ratio(F.sum("r"), F.sum("nf")).alias("user_reorder_ratio"),
        F.size(F.collect_set("aisle_id")).cast("long").alias("user_nb_aisles"),
        F.size(F.collect_set("department_id")).cast("long").alias("user_nb_departments"),
    )
    baskets = basket_sizes_by_user(lines)
    median_basket = seq.median_small_domain(baskets, ["user_id"], "basket_size", "user_median_basket")
    return (by_orders.join(by_pairs, "user_id", "left")
            .join(median_basket, "user_id", "left")
            .withColumn("user_average_basket", ratio("user_total_items", "user_total_orders")))


def basket_sizes_by_user(lines: DataFrame) -> DataFrame:
    """Basket size of each order with lines = max(add_to_cart_order), keyed by user."""
    return lines.groupBy("user_id", "order_id").agg(F.max("add_to_cart_order").alias("basket_size"))


# ---------------------------------------------------------------- products

def product_features(products: DataFrame, lines: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Products left-joined with line statistics; never-bought products keep NULL statistics.

    A4 purchase ordinals: a pair bought n times has ordinals 1..n, so the count of first
    purchases is the number of pairs and of second purchases the pairs with n >= 2 (no window).
    """
    pairs = pairs if pairs is not None else pair_counts(lines)
    stats = pairs.groupBy("product_id").agg(
        F.sum("n").alias("product_orders"),
        F.sum("r").alias("product_reorders"),
        F.count(F.lit(1)).alias("product_nb_users"),
        F.sum("pos").alias("_pos"),
        F.count(F.lit(1)).alias("prod_buy_first_time_total_cnt"),
        F.count_if(F.col("n") >= 2).alias("prod_buy_second_time_total_cnt"),
    )
    stats = stats.select(
        "product_id", "product_orders", "product_reorders",
        ratio("product_reorders", "product_orders").alias("product_reorder_rate"),
        "product_nb_users",
        ratio("_pos", "product_orders").alias("product_mean_add_to_cart_position"),
        "prod_buy_first_time_total_cnt", "prod_buy_second_time_total_cnt",
        ratio("prod_buy_second_time_total_cnt", "prod_buy_first_time_total_cnt")
        .alias("product_reorder_probability"),
    )
    return products.join(stats, "product_id", "left")


# ---------------------------------------------------------------- gaps

def lines_with_days_ago(lines: DataFrame, orders_days_ago: DataFrame) -> DataFrame:
    """J1 for the sequence features: each line gets its order's days_ago and hour of day."""
    return lines.join(orders_days_ago.select("order_id", "days_ago_since_last", "order_hour_of_day"),
                      "order_id")


def pair_gaps(lines_da: DataFrame) -> DataFrame:
    """Gap in days to the previous purchase of the same pair (NULL on the first one), as column ``gap``.

    A blocked lag: a (user, product) pair bought in a large share of all orders is still spread over bounded
    partitions. Lines that have the column already, such as a stage table of them, are returned as they are."""
    if "gap" in lines_da.columns:
        return lines_da
    x = seq.lag(lines_da, ["user_id", "product_id"], "order_number", "days_ago_since_last", "_prev_da")
    return x.withColumn("gap", F.col("_prev_da") - F.col("days_ago_since_last")).drop("_prev_da")


def product_gaps(lines_da: DataFrame) -> DataFrame:
    """Per product mean, population std, skewness and excess kurtosis of purchase gaps.

    The lag runs per (user, product) pair, then the moments are reduced by product from partial
    aggregates. Products without any repeat purchase have no row; zero variance gives NULL
    skewness / kurtosis.
    """
    g = pair_gaps(lines_da).where(F.col("gap").isNotNull())
    return g.groupBy("product_id").agg(
        F.avg("gap").alias("frequency_mean"),
        F.stddev_pop("gap").alias("frequency_std"),
        F.skewness("gap").alias("frequency_skew"),
        F.kurtosis("gap").alias("frequency_kurtosis"),
    )


def pair_history(lines_da: DataFrame) -> DataFrame:
    """One pass over each (user, product) purchase sequence: the accumulators of A13 and the
    gap statistics of A16-A18 share the lag window and a single aggregation."""
    g = pair_gaps(lines_da)
    return g.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("UP_orders"),
        # max_by keeps numeric aggregation buffers, so the aggregate stays a HashAggregate.
        F.max_by("order_id", "order_number").alias("UP_last_order_id"),
        F.max_by("order_hour_of_day", "order_number").alias("UP_last_order_hour"),
        F.max_by("days_ago_since_last", "order_number").alias("_last_days_ago"),
        F.sum("add_to_cart_order").alias("UP_sum_pos_in_cart"),
        F.min("order_number").alias("UP_first_order"),
        F.max("order_number").alias("UP_last_order"),
        F.sum("order_number").alias("_sum_on"),
        F.sum(day_weight("days_ago_since_last")).cast("double").alias("UP_recency_day"),
        F.sum(exp_weight("days_ago_since_last")).alias("UP_recency_exp"),
        F.avg("gap").alias("UP_interval_mean"),
        F.stddev_pop("gap").alias("UP_interval_std"),
    )


def pair_intervals(history: DataFrame) -> DataFrame:
    """A16-A18 per (user, product), from :func:`pair_history`.

    UP_interval_mean / _std: mean and population std of the gaps (NULL when bought once);
    UP_interval_distance: days_ago of the only purchase, else |days_ago of the latest - mean gap|;
    UP_order_number_skew: mean(order_number) / latest order_number.
    """
    return history.select("user_id", "product_id", "UP_interval_mean", "UP_interval_std", *distance_and_skew())


def distance_and_skew() -> list:
    """UP_interval_distance and UP_order_number_skew as expressions over pair_history columns."""
    return [
        F.when(F.col("UP_orders") == 1, F.col("_last_days_ago").cast("double"))
        .otherwise(F.abs(F.col("_last_days_ago") - F.col("UP_interval_mean")))
        .alias("UP_interval_distance"),
        ratio(F.col("_sum_on") / F.col("UP_orders"), "UP_last_order").alias("UP_order_number_skew"),
    ]


# ---------------------------------------------------------------- user x product

UP_COLUMNS = ["UP_orders", "UP_last_order_id", "UP_sum_pos_in_cart", "UP_first_order", "UP_last_order",
              "UP_recency", "UP_recency_day", "UP_recency_exp", "UP_order_rate_since_first_order"]


def with_user_order_count(history: DataFrame, user_orders) -> DataFrame:
    """A13 / A15 terms that need the user's order count (J13), applied at pair level:
    sum(1 + order_number / nb) = count + sum(order_number) / nb, and count / (nb - first + 1)."""
    nb = F.col(user_orders) if isinstance(user_orders, str) else user_orders
    return (history
            .withColumn("UP_recency", F.col("UP_orders") + ratio("_sum_on", nb))
            .withColumn("UP_order_rate_since_first_order",
                        ratio("UP_orders", nb - F.col("UP_first_order") + 1)))


def user_product_features(history: DataFrame, users: DataFrame) -> DataFrame:
    """A13-A15 per (user, product), from :func:`pair_history` and the user table."""
    nb = users.select("user_id", F.col("user_total_orders").alias("_nb"))
    x = with_user_order_count(history.join(nb, "user_id", "left"), "_nb")
    return x.select("user_id", "product_id", *UP_COLUMNS, "UP_last_order_hour")


# ---------------------------------------------------------------- streak

def order_streak(orders: DataFrame, lines: DataFrame, n_recent: int = STREAK_ORDERS) -> DataFrame:
    """Signed run length at the newest end of each pair's bought / not-bought sequence.

    Window: the user's last ``n_recent`` + 1 orders (the +1 is the target, which has no prior
    lines). Only orders with lines count; they are ranked 0, 1, ... from the newest. For a pair
    with rank set R: if 0 is in R the streak is the length of the run 0, 1, 2, ... in R,
    otherwise it is -min(R). Only pairs seen in the window get a row.
    """
    newest = Window.partitionBy("user_id").orderBy(F.col("order_number").desc())
    recent = (orders.select("order_id", "user_id", "order_number")
              .withColumn("_k", F.row_number().over(newest))
              .where(F.col("_k") <= n_recent + 1).drop("_k"))
    recent_lines = lines.select("order_id", "product_id").join(recent, "order_id")  # J4
    ranked_orders = (recent_lines.select("user_id", "order_id", "order_number").distinct()
                     .withColumn("_r", F.row_number().over(newest) - 1)
                     .select("order_id", "_r"))
    x = recent_lines.join(ranked_orders, "order_id")
    in_pair = Window.partitionBy("user_id", "product_id").orderBy("_r")
    x = x.withColumn("_run", F.col("_r") == F.row_number().over(in_pair) - 1)
    agg = x.groupBy("user_id", "product_id").agg(
        F.min("_r").alias("_min_r"), F.count_if("_run").alias("_run_len"))
    return agg.select(
        "user_id", "product_id",
        F.when(F.col("_min_r") == 0, F.col("_run_len")).otherwise(-F.col("_min_r"))
        .cast("int").alias("UP_order_streak"),
    )


def delta_hour_vs_last(target_hour, last_hour):
    """UP_delta_hour_vs_last: circular hour distance between the target order and the pair's last order."""
    return circular_hour_distance(target_hour, last_hour)
