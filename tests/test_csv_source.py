"""Reading an order history from CSV files: inference, rescue, the whole flow."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketflow.operators import model as md
from basketflow.sources import csv_source as cs
from basketflow.sources import retail_view as rv
from basketflow.sources.retail_view import load_retail
from tests.conftest import SF001

TEXT = """a,b,c,d,e,f
1,2.5,x,9999999999,,007
-2,1e3,,5,,+8
3,4,"y, z",6,,9
"""


def written(tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_inference_and_rescue(spark, tmp_path):
    path = written(tmp_path, TEXT)
    types = {r.column: (r.type, r.n_values, r.n_nulls) for r in cs.inferred_types(cs.read_text(spark, path)).collect()}
    assert types == {"a": ("int", 3, 0), "b": ("double", 3, 0), "c": ("string", 2, 1), "d": ("bigint", 3, 0), "e": ("string", 0, 3), "f": ("int", 3, 0)}
    rows = cs.read_inferred(spark, path).orderBy("a").collect()
    assert [tuple(r)[:6] for r in rows] == [(-2, 1000.0, None, 5, None, 8), (1, 2.5, "x", 9999999999, None, 7), (3, 4.0, "y, z", 6, None, 9)]
    assert all(r[cs.RESCUED] is None for r in rows)
    # Bad fields and two rows of a wrong length: kept, and the types hold with a tolerance (one long among many ints is bad too).
    path = written(tmp_path, TEXT + "four,1,w,1,,1\n5,1\n6,1,w,1,,1,2\n" + "7,1,w,1,,1\n" * 20, "bad.csv")
    assert {r.column: r.type for r in cs.inferred_types(cs.read_text(spark, path)).collect()}["a"] == "string"
    rows = cs.read_inferred(spark, path, tolerance=.05).collect()
    assert len(rows) == 26 and rows[0].__fields__[:6] == list("abcdef")
    bad = [r[cs.RESCUED] for r in rows if r[cs.RESCUED]]
    assert sorted(map(str, bad)) == sorted(map(str, [{"a": "four"}, {"d": "9999999999"}, {"_row": "5,1"}, {"_row": "6,1,w,1,,1,2"}]))


def test_a_file_without_rows(spark, tmp_path):
    path = written(tmp_path, "a,b\n")
    assert cs.read_inferred(spark, path).collect() == [] and cs.inferred_types(cs.read_text(spark, path)).collect() == []


def test_a_history_with_a_bad_row_is_refused_and_shown(spark, tmp_path):
    folder = str(tmp_path / "history")
    cs.write_history(load_retail(spark, SF001), folder)
    spark.createDataFrame([("x", "1", "1", "0")], "order_id string, product_id string, add_to_cart_order string, reordered string").write.mode(
        "append").option("header", True).csv(f"{folder}/{cs.FILES['train']}")
    assert [tuple(r) for r in cs.rescued(spark, folder).collect()] == [(cs.FILES["train"], "order_id", "x")]
    with pytest.raises(ValueError, match="do not parse"):
        cs.load_csv(spark, folder)


def test_lines_of_a_history_meet_their_orders_in_partitions_by_rows(spark, tmp_path, monkeypatch):
    """Neither side of the join is in the session's few partitions, and the rows are the same."""
    folder = str(tmp_path / "history")
    retail = load_retail(spark, SF001)
    cs.write_history(retail, folder)
    plain = {tuple(r) for r in cs.load_csv(spark, folder).lines.collect()}
    monkeypatch.setattr(rv, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(rv, "ROWS_WORTH_A_TASK", 100)
    lines = cs.load_csv(spark, folder).lines
    n = -(-retail.lines.where("eval_set != 'test'").count() // 100)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {n}), REPARTITION_BY_NUM") == 2
    assert {tuple(r) for r in lines.collect()} == plain


def test_the_flow_from_six_csv_files(spark, tmp_path):
    from basketflow.run import PRESETS, run_all
    folder, out = str(tmp_path / "history"), str(tmp_path / "run")
    retail = load_retail(spark, SF001)
    cs.write_history(retail, folder)
    presets = tuple(md.quick(p, max_iter=3, max_depth=3) for p in PRESETS)
    evaluation = run_all(spark, folder, out, presets, nmf_iterations=1, source="csv")
    assert evaluation.collect() == []
    decisions = spark.read.option("header", True).csv(f"{out}/decisions.csv")
    tests = retail.orders.where(F.col("eval_set") == "test")
    assert decisions.columns == ["order_id", "products"] and 0 < decisions.count() <= tests.count()
    assert decisions.join(tests.select(F.col("order_id").cast("string")), "order_id", "left_anti").count() == 0
    assert spark.read.parquet(f"{out}/matrix").where("eval_set = 'train'").agg(F.sum("label")).first()[0] > 0
