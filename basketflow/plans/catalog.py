"""The named queries: one callable (spark, sf_dir) -> DataFrame per operator group of the inventory.

Keys carry the inventory id prefix (s_ scans/sinks, p_ filters, a_ aggregates, w_ windows,
u_ unions, b_ baselines, e_ evaluation/decisions, m_ models, f_ feature matrix). Every query reads
the given tables through the retail view and runs over all of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.functions.exprs import round_doubles
from basketflow.operators import decisions as dc
from basketflow.operators import explore as ex
from basketflow.operators import features as ft
from basketflow.operators import matrix as mx
from basketflow.session import stage_path
from basketflow.sources import stage as st
from basketflow.sources.retail_view import Retail, dealt, load_retail

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values of the formula scores used to exercise blending and selection without a model
# (FIXTURES.md): score = ((user_id * m + product_id * p) % q + 1) / 1000.
FORMULA_A = (37, 11, 997)
FORMULA_B = (13, 29, 991)
# The single user whose history the notebook lists.
HISTORY_USER = 1


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# Session setting: when "true", queries read the retail view from stage tables written once per
# input folder (a pipeline running many queries over one snapshot), instead of deriving it inline.
STAGE_VIEW_CONF = "basketflow.retail.stage"


def _retail(spark: SparkSession, sf_dir: str) -> Retail:
    stage = spark.conf.get(STAGE_VIEW_CONF, "false").lower() == "true"
    return load_retail(spark, sf_dir, stage=stage)


def _staged(spark: SparkSession, sf_dir: str) -> Retail:
    """The view written once per input, for queries that read it many times."""
    return load_retail(spark, sf_dir, stage=True)


def _prior(r: Retail) -> DataFrame:
    return r.lines_of("prior", with_header=True)


def _out(df: DataFrame) -> DataFrame:
    return round_doubles(df, 6)


# ---------------------------------------------------------------- scans and sinks

@query("s_scan_orders")
def s_scan_orders(spark, sf_dir):
    return _retail(spark, sf_dir).orders


@query("s_scan_lines")
def s_scan_lines(spark, sf_dir):
    return _retail(spark, sf_dir).lines.select("order_id", "product_id", "add_to_cart_order", "reordered", "eval_set")


@query("s_scan_products")
def s_scan_products(spark, sf_dir):
    return _retail(spark, sf_dir).products


@query("w_days_ago")
def w_days_ago(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return ft.days_ago(r.orders).select(
        "order_id", "user_id", "order_number", "days_ago_since_last")


@query("s_roundtrip_stage")
def s_roundtrip_stage(spark, sf_dir):
    """Write a stage table under the shared folder and read it back by name."""
    path = stage_path(spark, "stages", f"days_ago-{uuid.uuid4().hex[:8]}")
    st.save(w_days_ago(spark, sf_dir), path)
    return st.load(spark, path)


@query("s_csv_sink_roundtrip")
def s_csv_sink_roundtrip(spark, sf_dir):
    """S6 + X1: decision-shaped rows written as CSV with a header and read back with a schema."""
    path = stage_path(spark, "sinks", f"truth-{uuid.uuid4().hex[:8]}")
    st.write_csv(e_ground_truth(spark, sf_dir), path)
    return st.read_decisions_csv(spark, path)


@query("s_csv_typed_scan")
def s_csv_typed_scan(spark, sf_dir):
    """The order table in the original CSV layout, read back with the declared schema
    (no inference pass; the empty gap of a first order reads as NULL)."""
    from basketflow.sources.tables import read_csv_typed
    path = stage_path(spark, "raw_csv", f"orders-{uuid.uuid4().hex[:8]}")
    st.write_csv(_retail(spark, sf_dir).orders, path)
    return read_csv_typed(spark, path, "orders")


@query("s_csv_inferred")
def s_csv_inferred(spark, sf_dir):
    """The six files of the history as CSV, types inferred over all rows."""
    from basketflow.sources import csv_source as cs
    folder = stage_path(spark, "raw_csv", f"history-{uuid.uuid4().hex[:8]}")
    cs.write_history(_retail(spark, sf_dir), folder)
    out = None
    for name, file in cs.FILES.items():
        part = cs.inferred_types(cs.read_text(spark, f"{folder}/{file}")).select(F.lit(name).alias("file"), "column", "type", "n_values", "n_nulls")
        out = part if out is None else out.unionByName(part)
    return out


@query("s_csv_history")
def s_csv_history(spark, sf_dir):
    """The lines of a history read from its CSV files, with their order's header."""
    from basketflow.sources import csv_source as cs
    folder = stage_path(spark, "raw_csv", f"history-{uuid.uuid4().hex[:8]}")
    cs.write_history(_retail(spark, sf_dir), folder)
    return cs.load_csv(spark, folder).lines.select("order_id", "product_id", "add_to_cart_order", "reordered", "eval_set", "user_id", "order_number")


@query("s_snapshots")
def s_snapshots(spark, sf_dir):
    """A snapshot of the orders by eval_set, one partition replaced, both versions read."""
    from basketflow.sources.snapshots import Snapshots
    table = Snapshots(spark, stage_path(spark, "snapshots", uuid.uuid4().hex[:12]))
    orders = _retail(spark, sf_dir).orders.select("order_id", "order_number", "eval_set")
    first = table.replace(orders, "eval_set")
    second = table.replace_partitions(orders.where(F.col("eval_set") == "train").withColumn("order_number", -F.col("order_number")), "eval_set")
    both = table.read(first).withColumn("version", F.lit(1)).unionByName(table.read(second).withColumn("version", F.lit(2)))
    return both.groupBy("version", "eval_set").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("order_number").alias("sum_number"))


# ---------------------------------------------------------------- filters

@query("p_eval_set_filter")
def p_eval_set_filter(spark, sf_dir):
    return _retail(spark, sf_dir).orders.where(F.col("eval_set") != "prior")


@query("p_user_history")
def p_user_history(spark, sf_dir):
    return _retail(spark, sf_dir).orders.where(F.col("user_id") == HISTORY_USER)


# ---------------------------------------------------------------- features

@query("a_product_stats")
def a_product_stats(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return _out(ft.product_features(r.products, _prior(r)))


@query("a_purchase_ordinals")
def a_purchase_ordinals(spark, sf_dir):
    r = _retail(spark, sf_dir)
    p = ft.product_features(r.products, _prior(r)).where(F.col("product_orders").isNotNull())
    return _out(p.select("product_id", "prod_buy_first_time_total_cnt", "prod_buy_second_time_total_cnt",
                         "product_reorder_probability"))


@query("a_user_features")
def a_user_features(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return _out(ft.user_features(r.orders, _prior(r), r.products))


@query("w_days_since_ratio")
def w_days_since_ratio(spark, sf_dir):
    r = _retail(spark, sf_dir)
    users = ft.user_features(r.orders, _prior(r), r.products)
    return _out(ft.days_since_ratio(r.orders, users).select("order_id", "user_id", "days_since_ratio"))


def _lines_da(r: Retail) -> DataFrame:
    return ft.lines_with_days_ago(_prior(r), ft.days_ago(r.orders))


@query("a_product_gaps")
def a_product_gaps(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return _out(ft.product_gaps(_lines_da(r)))


# Loads of an incremental run: ranges of order numbers.
LOADS = ((1, 4), (5, 9), (10, 2 ** 31 - 1))


@query("a_incremental_gaps")
def a_incremental_gaps(spark, sf_dir):
    """A12 from three loads: each adds its gaps to the stored last purchases, and its moment state to the stored ones."""
    from basketflow.operators import incremental as inc
    r = _retail(spark, sf_dir)
    root = stage_path(spark, "incremental", uuid.uuid4().hex[:12])

    def stored(df: DataFrame, name: str) -> DataFrame:
        st.save(df, f"{root}/{name}")
        return st.load(spark, f"{root}/{name}")

    lines = stored(dealt(_prior(r), r.parts, "order_id").join(dealt(inc.elapsed_days(r.orders), r.parts, "order_id"), "order_id"), "lines")
    last, states = None, []
    for i, (low, high) in enumerate(LOADS):
        load = lines.where(F.col("order_number").between(low, high))
        states.append(stored(inc.moment_state(inc.load_gaps(load, last, r.parts), ["product_id"], "gap"), f"state-{i}"))
        last = stored(inc.last_purchases(load, last, r.parts), f"last-{i}")
    return _out(inc.finish_moments(inc.merge_moments(states, ["product_id"]), ["product_id"], "frequency"))


@query("a_sketched_users")
def a_sketched_users(spark, sf_dir):
    """A2 by sketches: the union of two stored loads (which share users) against the exact count of each product."""
    from basketflow.operators import incremental as inc
    lines = _prior(_retail(spark, sf_dir))
    root = stage_path(spark, "incremental", uuid.uuid4().hex[:12])
    states = []
    for i in (0, 1):
        st.save(inc.distinct_sketch(lines.where(F.col("order_id") % 2 == i), ["product_id"], "user_id"), f"{root}/sketch-{i}")
        states.append(st.load(spark, f"{root}/sketch-{i}"))
    found = inc.distinct_estimate(inc.merge_sketches(states, ["product_id"]), ["product_id"])
    exact = ft.pair_counts(lines).groupBy("product_id").agg(F.count(F.lit(1)).alias("n_users"))
    near = F.abs(F.col("estimate") - F.col("n_users")) <= 4 * inc.standard_error() * F.col("n_users") + 0.5
    return exact.join(found, "product_id", "left").select("product_id", "n_users", F.coalesce(near, F.lit(False)).alias("within_error"))


@query("a_user_product")
def a_user_product(spark, sf_dir):
    r = _retail(spark, sf_dir)
    users = ft.user_features(r.orders, _prior(r), r.products)
    hist = ft.pair_history(_lines_da(r))
    return _out(ft.user_product_features(hist, users).drop("UP_last_order_hour"))


@query("a_pair_intervals")
def a_pair_intervals(spark, sf_dir):
    r = _retail(spark, sf_dir)
    hist = ft.pair_history(_lines_da(r))
    return _out(ft.pair_intervals(hist).drop("UP_order_number_skew"))


@query("a_pair_skew")
def a_pair_skew(spark, sf_dir):
    r = _retail(spark, sf_dir)
    hist = ft.pair_history(_lines_da(r))
    return _out(ft.pair_intervals(hist).select("user_id", "product_id", "UP_order_number_skew"))


@query("w_order_streak")
def w_order_streak(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return ft.order_streak(r.orders, _prior(r))


# ---------------------------------------------------------------- exploration

@query("a_eval_set_counts")
def a_eval_set_counts(spark, sf_dir):
    return ex.eval_set_counts(_retail(spark, sf_dir).orders)


@query("a_distinct_entities")
def a_distinct_entities(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return ex.distinct_entities(r.orders, r.products)


@query("a_history_histogram")
def a_history_histogram(spark, sf_dir):
    return _out(ex.history_histogram(_retail(spark, sf_dir).orders))


@query("a_basket_histogram")
def a_basket_histogram(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return _out(ex.basket_histogram(r.prior, r.parts))


@query("a_orders_by_hour")
def a_orders_by_hour(spark, sf_dir):
    return ex.orders_by(_retail(spark, sf_dir).orders, "order_hour_of_day")


@query("a_orders_by_dow")
def a_orders_by_dow(spark, sf_dir):
    return ex.orders_by(_retail(spark, sf_dir).orders, "order_dow")


@query("a_orders_by_gap")
def a_orders_by_gap(spark, sf_dir):
    return ex.orders_by(_retail(spark, sf_dir).orders, "days_since_prior_order")


@query("a_reorder_by_dow_hour")
def a_reorder_by_dow_hour(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return _out(ex.reorder_by_dow_hour(r.train, r.orders))


@query("a_reorder_pivot")
def a_reorder_pivot(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return _out(ex.reorder_pivot(r.train, r.orders))


@query("a_top_products")
def a_top_products(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return ex.top_products(r.prior, r.products)


def _rates(r: Retail) -> DataFrame:
    return ex.product_reorder_rates(r.prior, r.orders, r.products)


@query("a_reorder_rate_rank")
def a_reorder_rate_rank(spark, sf_dir):
    return _out(ex.reorder_rate_top(_rates(_retail(spark, sf_dir))))


@query("a_reorder_rate_bottom")
def a_reorder_rate_bottom(spark, sf_dir):
    return _out(ex.reorder_rate_bottom(_rates(_retail(spark, sf_dir))))


@query("a_reorder_by_cart_pos")
def a_reorder_by_cart_pos(spark, sf_dir):
    return _out(ex.reorder_by_cart_position(_retail(spark, sf_dir).prior))


@query("a_user_reordered_lists")
def a_user_reordered_lists(spark, sf_dir):
    """P3 + A28 + J5 + J6: for each target order, the reordered products of its user's prior orders.

    Coordinate form (one row per target order and product, with multiplicity): the list of the
    reference is the multiset of these rows; its length (X3) is num_products_reordered.
    """
    from basketflow.operators.factors import reordered_history
    return reordered_history(_retail(spark, sf_dir))


@query("u_basket_sentences")
def u_basket_sentences(spark, sf_dir):
    from basketflow.operators.embeddings import basket_sentences
    r = _retail(spark, sf_dir)
    s = basket_sentences(r.prior, r.train, parts=r.parts)
    return s.select("order_id", F.array_join("tokens", " ").alias("sentence"), F.size("tokens").cast("long").alias("n_tokens"))


# ---------------------------------------------------------------- baselines, truth, evaluation

@query("b_repeat_last_order")
def b_repeat_last_order(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return dc.repeat_last_order(_prior(r), r.orders)


@query("b_top_k_products")
def b_top_k_products(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return dc.top_k_products(_prior(r), r.orders)


@query("e_ground_truth")
def e_ground_truth(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return dc.ground_truth(r.train, r.orders.where(F.col("eval_set") == "train"), r.parts)


def _formula(coef: tuple[int, int, int]):
    m, p, q = coef
    return ((F.col("user_id") * m + F.col("product_id") * p) % q + 1).cast("double") / 1000


def formula_scores(candidates: DataFrame, coef: tuple[int, int, int]) -> DataFrame:
    return candidates.select("order_id", "product_id", _formula(coef).alias("prediction"))


def candidates(r: Retail) -> DataFrame:
    """Target orders x products their user bought in prior orders (the F0 key)."""
    pairs = ft.pair_counts(_prior(r)).select("user_id", "product_id")
    tgt = r.orders.where(F.col("eval_set") != "prior").select("order_id", "user_id")
    return pairs.join(tgt, "user_id")


def _stored_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two score tables in the prediction store, written and read back by path."""
    root = stage_path(spark, "predictions", uuid.uuid4().hex[:8])
    st.save(candidates(_retail(spark, sf_dir)), f"{root}/candidates")
    c = st.load(spark, f"{root}/candidates")
    for name, coef in (("a", FORMULA_A), ("b", FORMULA_B)):
        st.save(formula_scores(c, coef), f"{root}/{name}")
    return st.load(spark, f"{root}/a"), st.load(spark, f"{root}/b")


@query("s_prediction_store")
def s_prediction_store(spark, sf_dir):
    a, b = _stored_scores(spark, sf_dir)
    return a.withColumn("model", F.lit("a")).unionByName(b.withColumn("model", F.lit("b")))


@query("m_blend_scores")
def m_blend_scores(spark, sf_dir):
    return _out(dc.blend_scores(*_stored_scores(spark, sf_dir)))


@query("e_select_f1")
def e_select_f1(spark, sf_dir):
    return _out(dc.select_max_f1(dc.blend_scores(*_stored_scores(spark, sf_dir))))


@query("m_formula_metrics")
def m_formula_metrics(spark, sf_dir):
    """M9 on the formula scores of the train candidates against their lines."""
    from basketflow.operators.model import metrics_of
    r = _retail(spark, sf_dir)
    bought = r.train.select("order_id", "product_id").distinct().withColumn("label", F.lit(1))
    train = r.orders.where(F.col("eval_set") == "train").select("order_id")
    scored = formula_scores(candidates(r).join(train, "order_id", "left_semi"), FORMULA_A)
    return _out(metrics_of(scored.join(bought, ["order_id", "product_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))))


@query("m_normalised_rows")
def m_normalised_rows(spark, sf_dir):
    """M4 on formula factors of every user; every seventh user has an all-zero row."""
    from basketflow.operators.factors import normalize_rows
    users = _retail(spark, sf_dir).orders.select("user_id").distinct()
    w = users.select("user_id", F.array(*[((F.col("user_id") * (j + 3)) % 7).cast("double") for j in range(4)]).alias("w"))
    return _out(normalize_rows(w).select("user_id", *[F.col("factors")[j].alias(f"f{j}") for j in range(4)]))


@query("m_formula_pca")
def m_formula_pca(spark, sf_dir):
    """M2 on two-dimensional formula vectors of every product."""
    from pyspark.ml.functions import array_to_vector

    from basketflow.operators.embeddings import item_pca
    products = _retail(spark, sf_dir).products
    x = ((F.col("product_id") * 37) % 101).cast("double") / 10
    y = ((F.col("product_id") * 11) % 53).cast("double") / 10 + x / 2
    return _out(item_pca(products.select("product_id", array_to_vector(F.array(x, y)).alias("vector")), products))


def _formula_factors(spark, sf_dir, solver: str):
    """M3: one round from formula factors (k = 2) on the reordered counts; rows of both sides."""
    from basketflow.operators import factors as fa
    x = fa.reorder_counts(_retail(spark, sf_dir)).checkpoint()

    def start(key: str, a: tuple[int, int], b: tuple[int, int]) -> DataFrame:
        part = [((F.col(key) * m) % q + 1).cast("double") / 10 for m, q in (a, b)]
        return x.select(key).distinct().select(key, F.array(*part).alias("v"))

    w, h, _ = fa.user_factors(x, k=2, iterations=1, w_init=start("user_id", (7, 13), (5, 11)), h_init=start("product_id", (3, 17), (11, 7)), solver=solver)
    rows = [df.select(F.lit(side).alias("side"), F.col(key).cast("long").alias("id"), F.col(v)[0].alias("f0"), F.col(v)[1].alias("f1"))
            for df, side, key, v in ((w, "user", "user_id", "w"), (h, "product", "product_id", "h"))]
    return _out(rows[0].unionByName(rows[1]))


@query("m_nmf_round")
def m_nmf_round(spark, sf_dir):
    """M3: one round of multiplicative updates."""
    return _formula_factors(spark, sf_dir, "mu")


@query("m_nmf_sweep")
def m_nmf_sweep(spark, sf_dir):
    """M3: one sweep of coordinate descent."""
    return _formula_factors(spark, sf_dir, "cd")


def _baselines(r: Retail) -> dict[str, DataFrame]:
    prior = _prior(r)
    return {"repeat_last_order": dc.repeat_last_order(prior, r.orders), "top_k_products": dc.top_k_products(prior, r.orders)}


def _test_truth(r: Retail) -> DataFrame:
    return dc.ground_truth(r.test, r.orders.where(F.col("eval_set") == "test"), r.parts)


@query("e_mean_f1")
def e_mean_f1(spark, sf_dir):
    r = _retail(spark, sf_dir)
    return _out(dc.mean_f1_by_method(_baselines(r), _test_truth(r)))


# Pairs whose joins to their users and products are worth a pass of their own, and the most passes.
PAIRS_PER_PASS = 500_000
PASSES = 8


@query("f_feature_matrix")
def f_feature_matrix(spark, sf_dir):
    """the feature groups are written once; the pairs of a large table meet them in passes over a share of the users, so
    that disk holds the wide shuffles of one share."""
    scratch = st.Scratch(spark, "features")
    r = _staged(spark, sf_dir)
    t = kept_tables(spark, r, scratch)
    passes = max(1, min(-(-t.history.count() // PAIRS_PER_PASS), PASSES))
    mine = lambda df, i: df.where(F.pmod(F.xxhash64("user_id"), F.lit(passes)) == i)
    rows = [mx.feature_matrix(Retail(mine(r.orders, i), mine(r.lines, i), r.products, r.parts),
                              replace(t, users=mine(t.users, i), history=mine(t.history, i), streak=mine(t.streak, i))) for i in range(passes)]
    return scratch.keep(*[_out(m.select(*mx.KEY_COLUMNS, *mx.RELATIONAL_COLUMNS)) for m in rows])


def kept_tables(spark: SparkSession, r: Retail, scratch: st.Scratch | None = None) -> mx.FeatureTables:
    """The feature tables, written (to ``scratch``) with what several of them read; pair counts and lines with their gaps,
    which only they read, go."""
    scratch = scratch or st.Scratch(spark, "features")
    inner = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = scratch.keep(df)
        if name in ("pairs", "lines_days_ago"):
            inner.append(out)
        return out

    t = mx.feature_tables(r, keep)
    t = replace(t, **{name: scratch.keep(getattr(t, name)) for name in ("products", "frequency", "history", "streak")})
    scratch.drop(*inner)
    return t
