"""Blocked scans equal the plain window versions, with blocks small enough to cut every key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketflow.operators import sequences as seq


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for key, n in ((1, 200), (2, 17), (3, 1), (4, 5)):      # key 1 holds most rows
        order = rnd.sample(range(1, 10 * n + 2), n)          # sparse, unsorted order values
        for o in order:
            v = None if rnd.random() < 0.15 else float(rnd.randint(0, 30))
            rows.append((key, o, v, rnd.randint(1, 6)))
    return spark.createDataFrame(rows, "k long, o long, v double, basket int")


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_running_sum_and_lag(spark, skewed, block):
    w = Window.partitionBy("k").orderBy("o")
    want = skewed.select(
        "k", "o",
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.sum("v").over(Window.partitionBy("k")).alias("tot"),
        F.lag("v").over(w).alias("prev"))
    got = seq.running_sum(skewed, ["k"], "o", "v", "run", total_col="tot", block_size=block)
    got = seq.lag(got, ["k"], "o", "v", "prev", block_size=block)
    got = got.select("k", "o", "run", "tot", "prev")
    assert sorted(want.collect()) == sorted(got.collect())


def test_median_small_domain(spark, skewed):
    want = skewed.groupBy("k").agg(F.median("basket").alias("m"))
    got = seq.median_small_domain(skewed, ["k"], "basket", "m")
    assert sorted(want.collect()) == sorted(got.collect())


def test_view_numbering_does_not_depend_on_the_blocks(spark, monkeypatch):
    """Runs of two order keys and of all keys number the orders alike, as plain windows do."""
    from pyspark.sql import Window

    from basketflow.sources import retail_view as rv
    sf = "/root/testdata/sf0.01"
    wide = rv.load_retail(spark, sf)
    wide_orders, wide_lines = wide.orders.collect(), wide.lines.collect()
    monkeypatch.setattr(rv, "KEYS_PER_RUN", 2)
    narrow = rv.load_retail(spark, sf)
    assert sorted(narrow.orders.collect(), key=str) == sorted(wide_orders, key=str)
    assert sorted(narrow.lines.collect()) == sorted(wide_lines)
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    plain = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.row_number().over(w).alias("n"))
    assert {r.order_id: r.order_number for r in wide_orders} == {r.o_orderkey: r.n for r in plain.collect()}


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_rows = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 40), st.one_of(st.none(), st.integers(0, 9))),
                 min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=15, deadline=None)
@given(rows=_rows, block=st.integers(1, 8))
def test_blocked_scans_property(spark, rows, block):
    """Running sum (NULLs skipped, NULL until a value is seen), key total and lag equal their
    definitions for any keyed sequence and any block size."""
    df = spark.createDataFrame([(k, o, None if v is None else float(v)) for k, o, v in rows],
                               "k long, o long, v double")
    got = seq.running_sum(df, ["k"], "o", "v", "run", total_col="tot", block_size=block)
    got = seq.lag(got, ["k"], "o", "v", "prev", block_size=block)
    got = {(r.k, r.o): (r.run, r.tot, r.prev) for r in got.collect()}
    want = {}
    for key in {k for k, _, _ in rows}:
        seq_rows = sorted((o, v) for k, o, v in rows if k == key)
        vals = [v for _, v in seq_rows if v is not None]
        total = float(sum(vals)) if vals else None
        run, seen = 0.0, False
        for i, (o, v) in enumerate(seq_rows):
            if v is not None:
                run, seen = run + v, True
            prev = seq_rows[i - 1][1] if i else None
            want[(key, o)] = (run if seen else None, total, None if prev is None else float(prev))
    assert got == want


def test_hot_user_and_pair_default_blocks(spark):
    """A user with 3,000 orders (three default-size blocks) next to small users: days-ago, and the gaps
    of a product bought in every order, equal sums over the history, order by order."""
    import numpy as np

    from basketflow.operators import features as ft
    rng = np.random.default_rng(3)
    orders, want = [], {}
    for user, n in [(1, 3000)] + [(u, int(rng.integers(1, 20))) for u in range(2, 40)]:
        gaps = [0, *(int(g) for g in rng.integers(0, 31, n - 1))]
        for number in range(1, n + 1):
            orders.append((user * 10_000 + number, user, "prior", number, 0, number % 24, None if number == 1 else float(gaps[number - 1])))
            want[user * 10_000 + number] = sum(gaps) if number == 1 else sum(gaps[number:])
    o = spark.createDataFrame(orders, "order_id long, user_id long, eval_set string, order_number int, "
                                      "order_dow int, order_hour_of_day int, days_since_prior_order double")
    da = ft.days_ago(o)
    assert {r.order_id: r.days_ago_since_last for r in da.collect()} == want
    # the hot pair: user 1 buys product 7 in every order
    lines = (da.where("user_id = 1").select("order_id", "user_id", "order_number", "days_ago_since_last",
                                             "order_hour_of_day")
             .withColumn("product_id", F.lit(7)).withColumn("add_to_cart_order", F.lit(1)))
    iv = ft.pair_intervals(ft.pair_history(lines)).first()
    days = [want[10_000 + number] for number in range(1, 3001)]
    between = [a - b for a, b in zip(days, days[1:])]
    mean = sum(between) / len(between)
    assert iv.UP_interval_mean == pytest.approx(mean)
    assert iv.UP_interval_std == pytest.approx((sum((g - mean) ** 2 for g in between) / len(between)) ** .5)
    assert iv.UP_interval_distance == pytest.approx(abs(days[-1] - mean))
