"""Every relational query against its SQL oracle (DuckDB) at sf0.01: same columns, same rows."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001, SF01
from tests.oracle_check import compare, duck

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


# These need the trees or factors trained whole: minutes. tests/test_models.py runs them with small presets.
TRAINED = {"m_score_coverage", "m_factor_coverage"}


@pytest.mark.parametrize("key", sorted(set(SQL) - TRAINED))
def test_matches_oracle(spark, con, key):
    problems, n, _, _ = compare(spark, con, key, entry.queries()[key], SQL[key], SF01)
    assert not problems, problems
    assert n > 0


def test_every_query_has_oracle_or_is_learned():
    learned = {"m_item_vectors", "m_item_pca", "m_user_factors", "m_train_score_a", "m_train_score_b", "m_metrics",
               "m_training_trace", "e_model_decisions", "e_model_mean_f1"}
    corpus = {k for k in entry.queries() if k.startswith("op") or k == "pipeline"}
    assert set(entry.queries()) - set(SQL) - corpus == learned


def test_entry_smoke(spark):
    """The flagship at its own folder, row by row against the SQL of its query."""
    problems, n, _, _ = compare(spark, duck(SF001), "entry", lambda s, _: entry.entry(s), SQL["a_top_products"], SF001)
    assert not problems and n == 20, problems


def test_query_columns_are_unique_and_named(spark):
    """The driver sorts columns by name before hashing: every relational query must expose
    unique, non-empty, alias-free column names (no generated names like ``sum(x)``)."""
    for key in set(SQL) - TRAINED:
        cols = entry.queries()[key](spark, SF001).columns
        assert len(cols) == len(set(cols)), key
        assert all(c and "(" not in c and not c.startswith("_") for c in cols), (key, cols)


def test_bench_prints_one_json_line():
    """bench.py as the driver runs it: one JSON line with metric, value, unit, queries, sf."""
    import json
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, cwd=root,
                         capture_output=True, text=True, timeout=900)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d) and d["unit"] == "sec"
    assert "errors" not in d and d["value"] > 0 and len(d["queries"]) > 30
