"""Invariants of the learned operators (no exact oracle exists for seeded iterative training)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.operators import embeddings as em
from basketflow.operators import factors as fa
from basketflow.operators import model as md
from basketflow.operators.matrix import feature_matrix
from basketflow.sources.retail_view import load_retail
from tests.conftest import SF001


@pytest.fixture(scope="module")
def retail(spark):
    return load_retail(spark, SF001)


def test_item_vectors_and_pca(spark, retail):
    sentences = em.basket_sentences(retail.prior, retail.train)
    _, vectors = em.item_vectors(sentences)
    counts = sentences.select(F.explode("tokens").alias("t")).groupBy("t").count()
    vocab = counts.where(F.col("count") >= em.MIN_COUNT).count()
    assert vectors.count() == vocab
    assert len(vectors.first().vector) == em.VECTOR_SIZE
    pcs = em.item_pca(vectors, retail.products)
    assert pcs.count() == retail.products.count()
    in_vocab = pcs.join(vectors.select("product_id"), "product_id")
    means = in_vocab.agg(F.avg("vec1"), F.avg("vec2")).first()
    assert abs(means[0]) < 1e-6 and abs(means[1]) < 1e-6


def test_nmf_invariants(spark, retail):
    x = fa.reorder_counts(retail)
    w, h, errors = fa.user_factors(x, k=8, iterations=6)
    assert all(v >= 0 for r in h.collect() for v in r.h) and len(errors) == 6
    assert all(b <= a * (1 + 1e-9) for a, b in zip(errors, errors[1:]))
    norm = fa.normalize_rows(w)
    rows = norm.collect()
    assert len(rows) == x.select("user_id").distinct().count()
    for r in rows:
        v = np.asarray(r.factors)
        assert (v >= 0).all()
        assert abs(np.linalg.norm(v) - 1.0) < 1e-9 or np.linalg.norm(v) == 0.0


def test_nmf_one_iteration_matches_numpy(spark):
    xs = [(1, 1, 2.0), (1, 3, 1.0), (2, 2, 3.0), (3, 1, 1.0), (3, 2, 1.0), (3, 3, 4.0)]
    x = spark.createDataFrame(xs, "user_id long, product_id int, cnt double")
    rng = np.random.default_rng(0)
    w0, h0 = rng.random((3, 2)) + 0.1, rng.random((2, 3)) + 0.1
    w_init = spark.createDataFrame([(u + 1, w0[u].tolist()) for u in range(3)], "user_id long, w array<double>")
    h_init = spark.createDataFrame([(p + 1, h0[:, p].tolist()) for p in range(3)], "product_id int, h array<double>")
    w, h, _ = fa.user_factors(x, k=2, iterations=1, w_init=w_init, h_init=h_init)
    X = np.zeros((3, 3))
    for u, p, c in xs:
        X[u - 1, p - 1] = c
    h1 = h0 * (w0.T @ X) / (w0.T @ w0 @ h0 + fa.EPS)
    w1 = w0 * (X @ h1.T) / (w0 @ h1 @ h1.T + fa.EPS)
    got_h = {r.product_id: r.h for r in h.collect()}
    assert np.allclose(np.array([got_h[p] for p in (1, 2, 3)]).T, h1)
    got = {r.user_id: r.w for r in w.collect()}
    assert np.allclose(np.array([got[u] for u in (1, 2, 3)]), w1)


def planted_counts(spark, users=60, products=40, k=5, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.poisson((rng.random((users, k)) ** 3 * 3) @ (rng.random((k, products)) ** 3 * 3)).astype(float)
    rows = [(u, p, float(m[u, p])) for u in range(users) for p in range(products) if m[u, p]]
    return m, spark.createDataFrame(rows, "user_id long, product_id int, cnt double")


def test_coordinate_descent_sweep_matches_numpy(spark):
    m, x = planted_counts(spark)
    rng = np.random.default_rng(1)
    users, products = sorted({r.user_id for r in x.collect()}), sorted({r.product_id for r in x.collect()})
    w0, h0 = rng.random((len(users), 3)), rng.random((len(products), 3))
    w, h, losses = fa.user_factors(x, k=3, iterations=1, solver="cd", w_init=spark.createDataFrame(list(zip(users, w0.tolist())), "user_id long, w array<double>"),
                                   h_init=spark.createDataFrame(list(zip(products, h0.tolist())), "product_id int, h array<double>"))
    m = m[users][:, products]

    def sweep(v, numerator, gram):
        v = v.copy()
        for i in range(len(v)):
            for t in range(v.shape[1]):
                v[i, t] = max(0.0, v[i, t] + (numerator[i, t] - v[i] @ gram[:, t]) / gram[t, t])
        return v

    h1 = sweep(h0, m.T @ w0, w0.T @ w0)
    w1 = sweep(w0, m @ h1, h1.T @ h1)
    assert np.allclose([r.h for r in h.orderBy("product_id").collect()], h1) and np.allclose([r.w for r in w.orderBy("user_id").collect()], w1)
    assert np.isclose(losses[0], ((m - w1 @ h1.T) ** 2).sum())


def test_coordinate_descent_takes_a_third_of_the_rounds(spark):
    _, x = planted_counts(spark)
    _, _, slow = fa.user_factors(x, k=5, iterations=12, tolerance=0.0)
    w, h, fast = fa.user_factors(x, k=5, iterations=4, tolerance=0.0, solver="cd")
    assert fast[-1] <= slow[-1] and all(b <= a * (1 + 1e-9) for a, b in zip(fast, fast[1:]))
    assert all(v >= 0 for r in w.collect() for v in r.w) and all(v >= 0 for r in h.collect() for v in r.h)


def test_svd_start_matches_numpy(spark):
    """At full rank of the block the start equals the definition on numpy's singular vectors."""
    m, x = planted_counts(spark, users=30, products=12, k=12, seed=5)
    w, h, _ = fa.user_factors(x, k=4, iterations=0, solver="cd")
    users, products = [r.user_id for r in w.orderBy("user_id").collect()], [r.product_id for r in h.orderBy("product_id").collect()]
    m = m[users][:, products]
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    got_w, got_h = np.array([r.w for r in w.orderBy("user_id").collect()]), np.array([r.h for r in h.orderBy("product_id").collect()])
    for j in range(4):
        parts = []
        for sign in (1, -1):
            a, b = np.maximum(sign * u[:, j], 0), np.maximum(sign * vt[j], 0)
            parts.append((np.linalg.norm(a) * np.linalg.norm(b), a / np.linalg.norm(a), b / np.linalg.norm(b) if b.any() else b))
        size, a, b = max(parts, key=lambda p: p[0])
        assert np.allclose(got_w[:, j], np.sqrt(s[j] * size) * a, atol=1e-8) and np.allclose(got_h[:, j], np.sqrt(s[j] * size) * b, atol=1e-8)


def test_gbt_train_score_metrics(spark, retail):
    m = feature_matrix(retail).checkpoint()
    preset = md.quick(md.PRESET_B, max_iter=3, max_depth=3)
    model = md.train(m, preset)
    scores = md.score(model, m.where(F.col("eval_set") == "test"))
    assert scores.count() == m.where(F.col("eval_set") == "test").count()
    assert scores.where((F.col("prediction") < 0) | (F.col("prediction") > 1)).count() == 0
    met = md.metrics(model, m.where(F.col("eval_set") == "train")).first()
    assert 0.0 <= met.auc <= 1.0 and np.isfinite(met.logloss)


def test_trees_with_many_categories_find_a_planted_signal(spark):
    """134 aisles (more than the presets' bins) train, and a label set by a feature is learned."""
    from basketflow.operators.matrix import FEATURE_COLUMNS
    rng = np.random.default_rng(8)
    rows = []
    for i in range(3000):
        values = [float(x) for x in rng.random(len(FEATURE_COLUMNS))]
        values[FEATURE_COLUMNS.index("aisle_id")] = float(i % 134 + 1)
        values[FEATURE_COLUMNS.index("department_id")] = float(i % 21)
        ratio = values[FEATURE_COLUMNS.index("UP_orders_ratio")]
        rows.append((i, i, i, "train" if i % 3 else "test", int(ratio + rng.normal(0, .05) > .6), *values))
    names = ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    m = spark.createDataFrame(rows, f"order_id long, user_id long, product_id long, eval_set string, label int, {names}")
    model = md.train(m, md.quick(md.PRESET_A, max_iter=5, max_depth=4))
    assert md.metrics(model, m.where("eval_set = 'test'")).first().auc > 0.9


LEARNED = ["m_item_vectors", "m_item_pca", "m_user_factors", "m_train_score_a", "m_train_score_b",
           "m_metrics", "m_training_trace", "e_model_decisions", "e_model_mean_f1"]


@pytest.fixture()
def small(monkeypatch):
    """A few rounds: the queries' plumbing; learning itself is tested above."""
    from basketflow.plans import models as pm
    monkeypatch.setitem(pm.FACTORS, "iterations", 3)
    monkeypatch.setattr(pm, "PRESETS", {"a": md.quick(md.PRESET_A, max_iter=3, max_depth=3), "b": md.quick(md.PRESET_B, max_iter=3, max_depth=3)})


@pytest.mark.parametrize("key", LEARNED)
def test_learned_queries_run(spark, key, small):
    import __spark_entry__ as entry
    assert entry.queries()[key](spark, SF001).count() > 0


@pytest.mark.parametrize("key", ["m_score_coverage", "m_factor_coverage"])
def test_learned_results_cover_the_expected_keys(spark, key, small):
    import __spark_entry__ as entry
    from tests.oracle_check import compare, duck
    problems, n, _, _ = compare(spark, duck(SF001), key, entry.queries()[key], entry.oracle_sql()[key], SF001)
    assert not problems and n > 0, problems


def test_registered_queries_train_the_whole_presets():
    from basketflow.plans import models as pm
    assert pm.PRESETS == {"a": md.PRESET_A, "b": md.PRESET_B}
    assert (md.PRESET_A.max_iter, md.PRESET_A.max_depth, md.PRESET_B.max_iter, md.PRESET_B.max_depth) == (400, 12, 151, 6)


def test_run_all_end_to_end(spark, tmp_path):
    from basketflow.run import PRESETS, run_all
    from basketflow.operators import model as md
    presets = tuple(md.quick(p, max_iter=3, max_depth=3) for p in PRESETS)
    ev = {r.method: r for r in run_all(spark, SF001, str(tmp_path / "run"), presets, nmf_iterations=2).collect()}
    assert set(ev) == {"models", "repeat_last_order", "top_k_products"}
    assert all(0.0 <= r.mean_f1 <= 1.0 and r.n_orders > 0 for r in ev.values())
    decisions = spark.read.option("header", True).csv(str(tmp_path / "run" / "decisions.csv"))
    assert decisions.count() > 0
    run = tmp_path / "run"
    for csv in ("baseline_repeat_last_order.csv", "baseline_top_k_products.csv", "order_streaks.csv",
                "user_factors.csv"):
        assert spark.read.option("header", True).csv(str(run / csv)).count() > 0, csv
    for table in ("view/orders", "view/lines", "features/users", "features/lines_days_ago", "matrix",
                  "predictions/blend", "evaluation"):
        assert spark.read.parquet(str(run / table)).count() > 0, table
    for model in ("models/item_vectors", "models/gbt_a", "models/gbt_b"):
        assert (run / model).is_dir(), model
