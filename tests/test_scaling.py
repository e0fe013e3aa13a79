"""Steps that must not grow with the input: view partitions, block products, child counts."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow import run
from basketflow.operators import boosting as bo
from basketflow.operators import cooccurrence as co
from basketflow.operators import decisions as dc
from basketflow.operators import factors as fa
from basketflow.operators import incremental as inc
from basketflow.operators import matrix as mx
from basketflow.operators import model as md
from basketflow.plans import catalog
from basketflow.sources import retail_view as rv
from basketflow.sources import stage as st

SF = "/root/testdata/sf0.001"


def test_view_partitions_go_by_rows(spark, monkeypatch):
    """A task of the view holds a bounded number of rows whatever adaptive coalescing makes of their bytes."""
    n_orders, n_lines = (spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("orders", "lineitem"))
    plain = {tuple(r) for r in rv.build_lines(spark, SF, rv.build_orders(spark, SF)).collect()}
    monkeypatch.setattr(rv, "ROWS_PER_TASK", 100)
    assert rv._parts(spark, SF, "orders") == -(-n_orders // 100)
    lines = rv.build_lines(spark, SF, rv.build_orders(spark, SF))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning(order_id" in plan and f", {-(-n_lines // 100)}), REPARTITION_BY_NUM" in plan
    assert {tuple(r) for r in lines.collect()} == plain


def test_lines_meet_their_first_order_in_partitions_by_rows(spark, monkeypatch):
    """Neither side of the last join is in the session's few partitions."""
    monkeypatch.setattr(rv, "ROWS_PER_TASK", 100)
    n = rv._parts(spark, SF, "lineitem")
    plan = rv.build_lines(spark, SF, rv.build_orders(spark, SF))._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line and ", product_id" in line]
    assert dealt and all(f", {n})" in line for line in dealt)


def test_the_lines_are_derived_once(spark, monkeypatch):
    """The pair's first order takes no second reading, grouping and shuffle of the lines."""
    monkeypatch.setattr(rv, "ROWS_PER_TASK", 100)
    plan = rv.build_lines(spark, SF, rv.build_orders(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan parquet [l_orderkey" in line for line in plan.splitlines()) == 1


@pytest.mark.parametrize("rows_per_task", [100_000, 2])
def test_a_line_without_a_product_keeps_its_place(spark, tmp_path, monkeypatch, rows_per_task):
    """NULL keys: such a line counts in the cart and is no line of the view; a customer without a key has no lines."""
    monkeypatch.setattr(rv, "ROWS_PER_TASK", rows_per_task)
    day = "timestamp'2020-01-0{} 00:00:00'".format
    spark.sql(f"""select * from values (1L, 2L, {day(1)}), (2L, 2L, {day(2)}), (3L, cast(null as long), {day(3)}), (4L, 2L, {day(4)})
                  as t(o_orderkey, o_custkey, o_orderdate)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("""select * from values (1L, cast(null as long), 1), (1L, 5L, 2), (1L, 5L, 3), (2L, 5L, 1), (2L, 6L, 2), (3L, 5L, 1), (4L, 6L, 1),
                 (cast(null as long), 5L, 1), (2L, cast(null as long), 3) as t(l_orderkey, l_partkey, l_linenumber)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(50).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    lines = rv.build_lines(spark, str(tmp_path), rv.build_orders(spark, str(tmp_path)))
    got = sorted((r.order_id, r.product_id, r.add_to_cart_order, r.reordered, r.order_number) for r in lines.collect())
    assert got == [(1, 6, 2, 0, 1), (2, 6, 1, 1, 2), (2, 7, 2, 0, 2), (4, 7, 1, 1, 3)]


def test_tiles_multiply_as_numpy(spark, monkeypatch):
    """The product and its transpose, a tile of many steps and a hot row; a tile sends one sum per row, not one per coordinate."""
    monkeypatch.setattr(fa, "BAND_ROWS", 40)
    rng = np.random.default_rng(1)
    m = (rng.random((100, 90)) < 0.2) * rng.random((100, 90))
    m[7] = 1.0
    m[13] = 0.0
    x = spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], "row long, col int, value double")
    tiles = fa.Tiles(x, 100, 90)
    assert (fa.bands(100), fa.bands(90)) == (3, 3)
    for on, a in (("col", m), ("row", m.T)):
        v = rng.random((a.shape[1], 5))
        block = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], f"key {tiles.types[on]}, v array<double>")
        got = {r.key: r.v for r in tiles.times(block, on, 5).collect()}
        assert set(got) == set(np.flatnonzero(a.any(axis=1)))
        assert all(np.allclose(got[i], a[i] @ v) for i in got)


def _shuffled(spark):
    """Shuffles whose files are on disk."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)).split("_")[1] for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


def test_a_block_is_multiplied_in_slices_of_its_columns(spark, monkeypatch):
    """Slices, the last one narrower, give what the whole gives; none leaves its shuffle or its table on disk."""
    monkeypatch.setattr(fa, "PASS_BYTES", 8_000)
    rng = np.random.default_rng(2)
    m = (rng.random((60, 50)) < 0.2) * rng.random((60, 50))
    m[13] = 0.0
    x = spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], "row long, col int, value double")
    tiles = fa.Tiles(x, 60, 50, 11)
    assert tiles.slices == 5
    for on, a in (("col", m), ("row", m.T)):
        v = rng.random((a.shape[1], 11))
        scratch = st.Scratch(spark, "test")
        block = scratch.keep(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], f"key {tiles.types[on]}, v array<double>"))
        before = _shuffled(spark)
        with tiles.product(block, on, 11, scratch, spent=True) as product:
            assert _shuffled(spark) <= before and len(scratch.tables) == 1
            image = scratch.keep(product)
        assert _shuffled(spark) <= before and [t for t, _ in scratch.tables] == [image]
        got = {r.key: r.v for r in image.collect()}
        assert set(got) == set(np.flatnonzero(a.any(axis=1))) and all(np.allclose(got[i], a[i] @ v) for i in got)
        scratch.close()


def test_factors_and_vectors_leave_their_result_only(spark, monkeypatch):
    """However many steps, neither their stage tables nor their shuffles stay; slices change nothing but the rounding."""
    rng = np.random.default_rng(3)
    counts = spark.createDataFrame([(int(u), int(p), float(rng.integers(1, 5))) for u in range(50) for p in rng.choice(40, 6, False)],
                                   "user_id long, product_id int, cnt double")
    m = rng.random((30, 30))
    values = spark.createDataFrame([(a, b, float(m[a, b] + m[b, a])) for a in range(30) for b in range(30) if (a + b) % 3], "a int, b int, value double")
    keys = spark.range(32).select(F.col("id").cast("int").alias("product_id"))
    found = []
    for size in (2 ** 29, 10_000):
        monkeypatch.setattr(fa, "PASS_BYTES", size)
        spark.sparkContext._jvm.System.gc()
        before, scratch, other = _shuffled(spark), st.Scratch(spark, "test"), st.Scratch(spark, "test")
        w, h, losses = fa.user_factors(counts, k=5, iterations=2, tolerance=0.0, solver="cd", scratch=scratch)
        vectors = co.svd_vectors(values, keys, size=4, scratch=other)
        assert len(scratch.tables) == 3 and len(other.tables) == 2  # counts, W, H; keys, vectors
        assert len(_shuffled(spark) - before) <= 2 * len(losses) + 14  # sums that end in one row, and the coordinates that are held
        found.append((losses, np.array([r.vector for r in vectors.orderBy("product_id").collect()])))
        assert found[-1][1].shape == (32, 4)
        scratch.close()
        other.close()
    assert np.allclose(found[0][0], found[1][0]) and np.allclose(found[0][1], found[1][1], atol=1e-8)


def test_a_split_knows_the_rows_it_sends_left(spark):
    """Numbers, categories and NULLs: the children's rows come with the split, without a pass over the rows."""
    rows = [(1, 0, 0, 5, 9, 30), (1, 0, 1, -40, 20, 50), (1, 0, 2, 35, 21, 20), (2, 1, 0, 1, 1, 2), (2, 1, 1, 30, 9, 11), (2, 1, 2, -31, 8, 17)]
    unit = int(bo.UNIT)
    sums = spark.createDataFrame([(a, f, b, g * unit, h * unit, n) for a, f, b, g, h, n in rows], "node long, feature int, bin int, g long, h long, n long")
    rules = bo.Rules(0.0, 1, 0.0, 1.0, 5, (0, 1), (3, 3), (False, True))
    got = {r.node: r for r in bo.split_table(sums, rules).collect()}
    for node, r in got.items():
        left = {r.bin} if r.cats is None else set(r.cats)
        upto = {b for _, f, b, *_ in rows if f == r.feature and (b in left if r.cats is not None else 0 < b <= r.bin)} | ({0} if r.missing_left else set())
        assert r.n_left == sum(n for a, f, b, _, _, n in rows if a == node and f == r.feature and b in upto)
    assert set(got) == {1, 2}


def test_parts_of_a_bin_add_up_in_one_shuffle_by_feature(spark):
    """Sums as tasks send them: no step before the splits has to add them up, and no window orders the bins."""
    unit = int(bo.UNIT)
    rows = [(1, 0, b, g * unit, h * unit, n) for b, g, h, n in ((0, 5, 9, 30), (2, -40, 20, 50), (7, 35, 21, 20))]
    rules = bo.Rules(0.0, 1, 0.0, 1.0, 5, (0,), (9,), (False,))
    halves = [(a, f, b, g // 2, h // 2, n // 2) for a, f, b, g, h, n in rows]
    found = bo.split_table(spark.createDataFrame(halves * 2, "node long, feature int, bin int, g long, h long, n long"), rules)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    r = found.first()
    assert (r.feature, r.bin, r.missing_left, r.g, r.h, r.n, r.n_left) == (0, 2, False, 0, 50 * unit, 100, 50)


def test_a_subtree_grows_as_far_as_its_leaves_reach():
    """The nodes that best-first growth keeps, without the others of a fully grown tree."""
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 40, (6000, 3)).astype(np.uint8)
    g, h = np.rint(rng.normal(0, 1, 6000) * bo.UNIT), np.full(6000, bo.UNIT / 4)
    rules = lambda leaves: bo.Rules(1.0, 1, 0.0, 1.0, 11, (0, 1, 2), (40, 40, 40), (False, True, False), leaves)
    whole, some = (bo._grow(1, codes, g, h, rules(leaves)) for leaves in (0, 12))
    assert len(some) < len(whole) / 4
    assert bo._best_first(some, 12, 0.0) == bo._best_first(whole, 12, 0.0)
    assert all(some[i] == whole[i] for i in some)


def test_metrics_score_their_rows_once(spark):
    """AUC and log-loss are several jobs over rows that are computed in one."""
    seen = spark.sparkContext.accumulator(0)

    def scored(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = spark.createDataFrame([(1, 0.8), (0, 0.4), (1, 0.3), (0, 0.1)], "label int, prediction double")
    got = md.metrics_of(rows.mapInPandas(scored, rows.schema)).first()
    assert seen.value == 4
    assert got.auc == 0.75 and np.isclose(got.logloss, -np.log([0.8, 0.6, 0.3, 0.9]).mean())


def test_the_panel_is_found_once(monkeypatch):
    """An order's integrals use the same points and weights of a panel, which are not found again."""
    want = dc.expected_f1_table(np.array([0.9, 0.5, 0.2]))
    monkeypatch.setattr(np.polynomial.legendre, "leggauss", lambda n: pytest.fail("found again"))
    assert np.array_equal(dc.expected_f1_table(np.array([0.9, 0.5, 0.2])), want)


def test_co_occurring_lines_meet_in_partitions_by_rows(spark):
    """Neither side of the join is in the session's few partitions, and the counts are the same."""
    lines = spark.createDataFrame([(o, (o * 7 + i * i) % 11, i) for o in range(40) for i in range(1, 9)], "order_id long, product_id int, place int")
    got = co.cooccurrence(lines, 3, parts=37)
    assert got._jdf.queryExecution().executedPlan().toString().count(", 37), REPARTITION_BY_NUM") == 4  # both ways of a pair
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in co.cooccurrence(lines, 3).collect()}


def test_loads_meet_what_is_stored_in_partitions_by_rows(spark):
    """Lags, gaps and last purchases of a load: no step is in the session's few partitions, and the rows are the same."""
    rows = [(u, p, n, n * (u + 1) + p) for u in range(6) for p in range(4) for n in range(1, 9) if (u * p + n) % 3]
    lines = spark.createDataFrame(rows, "user_id long, product_id int, order_number int, elapsed int")
    first, second = lines.where("order_number < 5"), lines.where("order_number >= 5")
    session = f", {spark.conf.get('spark.sql.shuffle.partitions')})"
    found = []
    for parts in (0, 37):
        last = inc.last_purchases(first, parts=parts)
        dfs = [inc.load_gaps(first, parts=parts), inc.load_gaps(second, last, parts), inc.last_purchases(second, last, parts)]
        found.append([sorted(tuple(r) for r in df.collect()) for df in dfs])
        plans = "".join(df._jdf.queryExecution().executedPlan().toString() for df in dfs)
        assert (session in plans) == (parts == 0) and (", 37)" in plans) == (parts == 37)
    assert found[0] == found[1] and all(found[0])


def _order_exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(order_id" in line]


def test_baskets_are_counted_in_partitions_by_rows(spark, monkeypatch):
    """No lines of an order meet in the session's few partitions, and the counts are the same."""
    plain = {tuple(r) for r in catalog.a_basket_histogram(spark, SF).collect()}
    monkeypatch.setattr(rv, "ROWS_PER_TASK", 100)
    got = catalog.a_basket_histogram(spark, SF)
    found = _order_exchanges(got)
    assert found and all(f", {rv._parts(spark, SF, 'lineitem')})" in line for line in found)
    assert {tuple(r) for r in got.collect()} == plain


def test_sentences_are_made_in_partitions_by_rows(spark, monkeypatch):
    """No lines of an order are collected in the session's few partitions, and the sentences are the same."""
    plain = {tuple(r) for r in catalog.u_basket_sentences(spark, SF).collect()}
    monkeypatch.setattr(rv, "ROWS_PER_TASK", 100)
    got = catalog.u_basket_sentences(spark, SF)
    found = _order_exchanges(got)
    assert found and all(f", {rv._parts(spark, SF, 'lineitem')})" in line for line in found)
    assert {tuple(r) for r in got.collect()} == plain


def test_truth_is_made_in_partitions_by_rows(spark, monkeypatch):
    """Neither the lines of an order nor the orders are in the session's few partitions, and the rows are the same; so through the CSV sink."""
    plain = {tuple(r) for r in catalog.e_ground_truth(spark, SF).collect()}
    monkeypatch.setattr(rv, "ROWS_PER_TASK", 100)
    got = catalog.e_ground_truth(spark, SF)
    found = _order_exchanges(got)
    assert found and all(f", {rv._parts(spark, SF, 'lineitem')})" in line for line in found)
    assert {tuple(r) for r in got.collect()} == plain == {tuple(r) for r in catalog.s_csv_sink_roundtrip(spark, SF).collect()}


@pytest.mark.parametrize("parts", [0, 37])
def test_orders_without_lines_read_none(spark, parts):
    """An order that repeats is there as often, and a key that is NULL meets no lines."""
    lines = spark.createDataFrame([(1, 7, 2, 1), (1, 5, 1, 1), (2, 7, 1, 0), (None, 9, 1, 1)], "order_id long, product_id int, add_to_cart_order int, reordered int")
    orders = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "order_id long")
    got = sorted(((r.order_id or 0, r.products) for r in dc.ground_truth(lines, orders, parts).collect()))
    assert got == [(0, "None"), (1, "5 7"), (2, "None"), (3, "None"), (3, "None")]


def test_the_job_deals_out_by_the_rows_of_its_tables(spark, tmp_path, monkeypatch):
    """The view of a whole job carries the number of partitions its truth goes by."""
    class Built(Exception):
        pass

    def retail(*args, **named):
        raise Built(rv.Retail(*args, **named).parts)

    monkeypatch.setattr(rv, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(run, "Retail", retail)
    with pytest.raises(Built) as found:
        run.run_all(spark, SF, str(tmp_path))
    assert found.value.args == (rv._parts(spark, SF, "lineitem"),) and found.value.args[0] > 1


def test_the_matrix_is_made_in_passes_over_the_users(spark, monkeypatch):
    """Passes give the rows of the one plan; pair counts, lines with their gaps and all shuffles are gone."""
    kept = []
    keep = st.Scratch.keep
    monkeypatch.setattr(st.Scratch, "keep", lambda self, df, *more: kept.append((self, len(more))) or keep(self, df, *more))
    monkeypatch.setattr(catalog, "PAIRS_PER_PASS", 700)
    r = rv.load_retail(spark, SF, stage=True)
    want = catalog._out(mx.feature_matrix(r).select(*mx.KEY_COLUMNS, *mx.RELATIONAL_COLUMNS))
    n = want.count()
    spark.sparkContext._jvm.System.gc()
    before = _shuffled(spark)
    got = catalog.f_feature_matrix(spark, SF)
    assert kept[-1][1] == -(-n // 700) - 1 >= 2
    assert _shuffled(spark) <= before
    tables = {path for _, path in kept[-1][0].tables}
    assert len(tables) == 7 and all(os.path.exists(path) for path in tables)  # users, days ago, four groups, the matrix
    assert len(os.listdir(kept[-1][0].root)) == 7
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
