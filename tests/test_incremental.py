"""Merged states against the statistics of all rows at once."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from basketflow.operators import features as ft
from basketflow.operators import incremental as inc
from basketflow.sources.retail_view import load_retail
from tests.conftest import SF001


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(b)))


def test_merged_moments_equal_one_pass(spark):
    r = random.Random(2)
    rows = [(i % 3, r.choice("abc"), None if r.random() < .1 else 1e6 + r.gauss(0, 1) ** 3) for i in range(900)]
    rows += [(i % 3, "flat", 7.0) for i in range(9)] + [(0, "once", 3.5), (1, "null", None), (0, "two", 1.0), (2, "two", 2.0)]
    df = spark.createDataFrame(rows, "load int, k string, v double")
    whole = {x.k: x for x in df.where("v is not null").groupBy("k").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.skewness("v").alias("skew"),
                                                                   F.kurtosis("v").alias("kurt")).collect()}
    states = [inc.moment_state(df.where(F.col("load") == i), ["k"], "v") for i in range(3)]
    # In one merge, and load after load.
    for merged in (inc.merge_moments(states, ["k"]), inc.merge_moments([inc.merge_moments(states[:2], ["k"]), states[2]], ["k"])):
        got = {x.k: x for x in inc.finish_moments(merged, ["k"], "v").collect()}
        assert set(got) == set(whole) == {"a", "b", "c", "flat", "once", "two"}
        for k, x in got.items():
            w = whole[k]
            assert close(x.v_mean, w["mean"]) and close(x.v_std, w["std"]), k
            assert (x.v_skew is None) == (w["skew"] is None) and (x.v_kurtosis is None) == (w["kurt"] is None), k
            # Third and fourth moments of values near 10^6 lose some digits in either form.
            assert w["skew"] is None or (abs(x.v_skew - w["skew"]) < 1e-6 and abs(x.v_kurtosis - w["kurt"]) < 1e-6), k


def test_gaps_of_three_loads_equal_those_of_all_orders(spark):
    retail = load_retail(spark, SF001)
    prior = retail.lines_of("prior", with_header=True)
    elapsed = inc.elapsed_days(retail.orders)
    lines = prior.join(elapsed, "order_id").checkpoint()
    last, gaps = None, []
    for low, high in ((0, 4), (5, 9), (10, 10_000)):
        load = lines.where(F.col("order_number").between(low, high))
        gaps.append(inc.load_gaps(load, last))
        last = inc.last_purchases(load, last).checkpoint()
    got = sorted(tuple(r) for g in gaps for r in g.select("user_id", "product_id", "gap").collect())
    want = ft.pair_gaps(ft.lines_with_days_ago(prior, ft.days_ago(retail.orders))).where("gap is not null")
    assert got == sorted(tuple(r) for r in want.select("user_id", "product_id", F.col("gap").cast("int")).collect()) and len(got) > 500
    assert last.count() == prior.select("user_id", "product_id").distinct().count()


def test_sketches_of_two_halves_equal_the_whole(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), (F.col("id") * F.col("id") % 40_009).alias("v"), (F.rand(1) < .5).alias("half"))
    df = df.unionByName(spark.createDataFrame([(9, None, True), (8, 5, False)], "k long, v long, half boolean")).checkpoint()
    exact = {r.k: r.n for r in df.groupBy("k").agg(F.count_distinct("v").alias("n")).collect()}
    whole = {r.k: r.estimate for r in inc.distinct_estimate(inc.distinct_sketch(df, ["k"], "v"), ["k"]).collect()}
    # The halves share rows: a union counts a value once.
    parts = [inc.distinct_sketch(df.where(c), ["k"], "v") for c in ("half or v % 5 = 0", "not half")]
    merged = {r.k: r.estimate for r in inc.distinct_estimate(inc.merge_sketches(parts, ["k"]), ["k"]).collect()}
    assert set(merged) == set(whole) == {0, 1, 2, 8} and merged[8] == 1
    for k in (0, 1, 2):
        assert abs(merged[k] - exact[k]) <= 4 * inc.standard_error() * exact[k] and abs(merged[k] - whole[k]) <= 2 * inc.standard_error() * exact[k]
    assert np.isclose(inc.standard_error(12), .01625)
