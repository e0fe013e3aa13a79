"""End-to-end run: the reference's scripts in order, with stage tables between the steps.

    python -m basketflow.run --input /root/testdata/sf0.1 --output <folder> [--source csv]

Steps (each writes Parquet stage tables or CSV files under ``--output``, which on a cluster must
be a shared folder; by default a folder under ``spark.checkpoint.dir``):

  1. retail view                         -> view/ (orders, lines partitioned by eval_set, products)
  2. feature groups                      -> features/<group> (shared intermediates staged first)
  3. co-occurrence vectors, PCA          -> models/item_vectors, features/product_vectors
  4. feature matrix                      -> matrix/ (partitioned by eval_set)
  5. two boosted-tree trainers           -> models/gbt_a, models/gbt_b (node tables), predictions/a, predictions/b
  6. 0.7 / 0.3 blend                     -> predictions/blend
  7. expected-F1 decisions per order     -> decisions.csv/
  8. baselines, streaks, user factors    -> baseline_*.csv/, order_streaks.csv/, user_factors.csv/
  9. mean F1 against the hidden answer   -> evaluation/ (and returned)

Every later step reads the staged output of the earlier ones, so a lost executor costs a
re-read rather than a recomputation of the history, and each plan stays short.
"""

from __future__ import annotations

import argparse
import os

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators import boosting as bo
from basketflow.operators import cooccurrence as co
from basketflow.operators import decisions as dc
from basketflow.operators import embeddings as em
from basketflow.operators import factors as fa
from basketflow.operators import matrix as mx
from basketflow.operators import model as md
from basketflow.session import get_spark, stage_path
from basketflow.sources import stage as st
from basketflow.sources import retail_view as rv
from basketflow.sources.csv_source import load_csv
from basketflow.sources.retail_view import Retail

PRESETS = (md.PRESET_A, md.PRESET_B)


def _staged(spark: SparkSession, df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    st.save(df, path, partition_by)
    return st.load(spark, path)


def run_all(spark: SparkSession, input_dir: str, output_dir: str | None = None,
            presets=PRESETS, nmf_iterations: int = fa.MAX_ITERATIONS, source: str = "tables") -> DataFrame:
    """Run every step; returns the evaluation table (method, mean_f1, n_orders).

    ``source`` is "tables" (the given parquet tables) or "csv" (the history's own CSV files). CSV files do not hold
    the test orders' lines, so nothing can be evaluated: the table is empty then.
    """
    out = output_dir or stage_path(spark, "run")
    j = lambda *p: os.path.join(out, *p)

    # 1. view: orders first, lines derived from the staged orders
    if source == "csv":
        read = load_csv(spark, input_dir)
        retail = Retail(_staged(spark, read.orders, j("view", "orders")), _staged(spark, read.lines, j("view", "lines"), ["eval_set"]),
                        _staged(spark, read.products, j("view", "products")), read.parts)
    else:
        orders = _staged(spark, rv.build_orders(spark, input_dir), j("view", "orders"))
        retail = Retail(orders,
                        _staged(spark, rv.build_lines(spark, input_dir, orders), j("view", "lines"), ["eval_set"]),
                        _staged(spark, rv.build_products(spark, input_dir), j("view", "products")), rv._parts(spark, input_dir, "lineitem"))

    # 2. feature groups; the intermediates several groups read are staged first
    staged = set()

    def keep(df, name):
        staged.add(name)
        return _staged(spark, df, j("features", name))

    t = mx.feature_tables(retail, materialize=keep)
    t = mx.FeatureTables(**{name: df if name in staged else keep(df, name) for name, df in vars(t).items()})

    # 3. item vectors
    vectors = _staged(spark, co.item_vectors(retail.prior, retail.train), j("models", "item_vectors"))
    vectors = vectors.select("product_id", array_to_vector("vector").alias("vector"))
    pv = _staged(spark, em.item_pca(vectors, retail.products), j("features", "product_vectors"))

    # 4. feature matrix
    m = _staged(spark, mx.feature_matrix(retail, t, pv), j("matrix"), ["eval_set"])
    test = m.where(F.col("eval_set") == "test")

    # 5-6. trainers, scores, blend
    preds = []
    for preset in presets:
        model = _staged(spark, bo.train(m, preset), j("models", f"gbt_{preset.name}"))
        preds.append(_staged(spark, bo.score(model, test), j("predictions", preset.name)))
    blend = _staged(spark, dc.blend_scores(*preds), j("predictions", "blend"))

    # 7. decisions
    decisions = dc.select_max_f1(blend).select("order_id", "products")
    st.write_csv(decisions, j("decisions.csv"))

    # 8. side outputs of the reference
    prior = retail.lines_of("prior", with_header=True)
    st.write_csv(dc.repeat_last_order(prior, retail.orders), j("baseline_repeat_last_order.csv"))
    st.write_csv(dc.top_k_products(prior, retail.orders), j("baseline_top_k_products.csv"))
    st.write_csv(t.streak, j("order_streaks.csv"))
    w, _, _ = fa.user_factors(fa.reorder_counts(retail), iterations=nmf_iterations, solver="cd")
    factors = fa.normalize_rows(w)
    st.write_csv(factors.select("user_id", F.array_join(F.transform("factors", lambda v: v.cast("string")), " ")
                                .alias("factors")), j("user_factors.csv"))

    # 9. evaluation against the hidden test orders
    if retail.test.isEmpty():
        return _staged(spark, spark.createDataFrame([], "method string, mean_f1 double, n_orders long"), j("evaluation"))
    truth = dc.ground_truth(retail.test, retail.orders.where(F.col("eval_set") == "test"), retail.parts)
    read_back = st.read_decisions_csv(spark, j("decisions.csv"))
    named = {"models": read_back, **{n: st.read_decisions_csv(spark, j(f"baseline_{n}.csv")) for n in ("repeat_last_order", "top_k_products")}}
    ev = dc.mean_f1_by_method(named, truth)
    return _staged(spark, ev, j("evaluation"))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True, help="folder with the input tables or files")
    ap.add_argument("--output", default=None, help="shared output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--source", choices=["tables", "csv"], default="tables", help="given tables, or the history's own CSV files")
    ap.add_argument("--master", default=None, help="e.g. local[8]; leave unset under spark-submit")
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    ev = run_all(spark, a.input, a.output, source=a.source)
    for row in ev.collect():
        print(f"{row.method:20s} mean F1 {row.mean_f1:.4f} over {row.n_orders} orders")


if __name__ == "__main__":
    main()
