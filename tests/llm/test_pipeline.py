"""Every query and the pipeline: SQL, odd inputs, empty tables, clashing columns, a brute-force run."""

from __future__ import annotations

import os
import re

import pytest

from basketflow.llm import queries
from tests.llm import brute
from tests.oracle_check import duck

SF = "/root/testdata/sf0.001"


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    res = duck(SF).execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    pick = lambda r, cols: tuple(_norm(r[c]) for c in sorted(cols))
    assert sorted((pick(r, names) for r in df.collect()), key=str) == sorted((pick(dict(zip(names, r)), names) for r in res.fetchall()), key=str)


def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))


def _tables(spark, folder, docs, extra=""):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long" + extra).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, tmp_path, name):
    folder = str(tmp_path / "empty")
    _tables(spark, folder, [])
    assert queries.QUERIES[name](spark, folder).collect() == []


def test_stages_keep_clashing_columns_and_odd_rows(spark, tmp_path):
    import corpus_pipeline as p
    words = [f"w{i}" for i in range(200)]
    odd = ["c"] * 9
    text = lambda k: " ".join(words[k:k + 70])
    rows = [(1, text(0), "en", "a", 1, *odd), (1, text(0), "en", "a", 1, *odd), (None, text(60), None, None, None, *odd), (2, None, "en", "a", 0, *odd),
            (3, "", "en", "a", 0, *odd), (4, text(100) + "\n" + text(20), "en", "b", 5, *odd), (5, "z " * 30_000 + text(90), "en", "b", 5, *odd),
            (6, text(30), None, "a", 1, *odd), (6, text(110), None, "a", 1, *odd)]
    names = ["_row", "rest", "ord", "dk", "size", "kept", "n_words", "_key", "score"]
    folder = str(tmp_path / "odd")
    _tables(spark, folder, rows, "".join(f", {n} string" for n in names))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(p.STAGES[:-1]):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert all(getattr(r, n) == "c" for r in out.collect() for n in names)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    assert docs.count() > 0
    assert p.STAGES[-1][1](spark, docs, folder).where("not round_trip").count() == 0
    _tables(spark, str(tmp_path / "none"), [])
    assert p.run(spark, str(tmp_path / "none")).collect() == []


def test_pipeline_against_brute_force(spark, tmp_path):
    """Stage by stage: what goes, what is cut, who stays, how often each is taken, and the round trip."""
    import corpus_pipeline as p

    from basketflow.llm import quality as ql
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = ql.fit(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stage = []
    for k, (_, f) in enumerate(p.STAGES):
        f(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        stage.append(docs.collect())
    kept = []
    for d, t in rows:
        n = len(b := brute.quality_buckets(t, ql.BUCKETS)) // 2
        if not brute.quality_measures(t)[5] and round(sum(model.ratios[x] for x in b[:n]) / n, 9) >= model.threshold:
            kept.append((d, t))
    assert sorted((r.doc_id, r.text) for r in stage[0]) == kept
    cut = [(d, t) for d, t, _, _ in brute.line_dedup(kept)]
    assert sorted((r.doc_id, r.text) for r in stage[1]) == sorted(cut)
    near = brute.simhash_components(cut)
    one = {d for d, _, c in near if d == c}
    assert sorted(r.doc_id for r in stage[2]) == sorted(one)
    took: dict = {}
    for r in stage[3]:
        took[r.doc_id] = took.get(r.doc_id, 0) + 1
    assert set(took) <= one and max(took.values()) <= 2
    assert sum(len(brute.words_of(r.text)) for r in stage[3]) == pytest.approx(1.5 * sum(len(brute.words_of(r.text)) for r in stage[2]), rel=.05)
    assert len(stage[4]) == len(stage[3]) and all(r.round_trip for r in stage[4])
    assert sorted(r.doc_id for r in stage[4]) == sorted(r.doc_id for r in stage[3])


def test_the_rest_imports_without_the_subpackage(tmp_path):
    """With both folders and the pipeline gone the entry still lists the other queries."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/basketflow", tmp_path / "basketflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not any(n.startswith('op') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_one_of_equal_rows_stays(spark):
    """Equal rows, copies without an id and one id with two texts: of each group one row, with its own columns."""
    import corpus_pipeline as p
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, text(1), "a")] * 5 + [(2, text(1), "b")] + [(None, text(2), "a")] * 40 + [(None, text(3), "a"), (None, text(3), "b"), (7, text(3), "c")]
    rows += [(9, text(4), "a"), (9, text(5), "a"), (9, text(5), "a"), (None, None, "n"), (None, "", "n")]
    out = p.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7), "").collect()
    got = sorted(((r.doc_id, r.text) for r in out if r.text), key=str)
    assert got == sorted([(1, text(1)), (None, text(2)), (7, text(3)), (9, text(4)), (9, text(5))], key=str)
    assert all(r.source == "c" for r in out if r.doc_id == 7)
    assert sum(not r.text for r in out) == 1


def test_training_order_reaches_the_result(spark, tmp_path):
    """Ranks follow the schedules, and encode's position is the mix's order though the files are read out of order."""
    import corpus_pipeline as p

    from basketflow.llm import curriculum as cu
    from basketflow.llm.common import Stages
    rows = [(d, f"w{d} " * (1 + d % 30), "abc"[d % 3]) for d in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # Every source with one schedule rising from 0.1 to 3, but the first, which falls: its copies come early.
    turned = dict(schedules=((3.0, .1), (.1, 3.0), (.1, 3.0)))
    order = {}
    for name, options in (("given", {}), ("turned", turned)):
        out = cu.training_order(cu.doc_sizes(docs), Stages(spark, "t"), **options).orderBy("rank").collect()
        assert [r["rank"] for r in out] == list(range(len(out)))
        assert [r.position for r in out] == sorted(r.position for r in out) and 0 < out[0].position and out[-1].position <= 1
        order[name] = out
    first = lambda out: sum(r.source == "a" for r in out[:len(out) // 4])
    assert first(order["turned"]) > 1.2 * first(order["given"])
    mixed = cu.mix(docs, Stages(spark, "t"))
    folder = str(tmp_path / "mixed")
    mixed.write.option("maxRecordsPerFile", 40).parquet(folder)
    coded = p.encode(spark, spark.read.parquet(folder), "").collect()
    assert len({r.position for r in coded}) == len(coded) > 900
    assert [r.doc_id for r in sorted(coded, key=lambda r: r.position)] == [r.doc_id for r in order["given"]]
    assert {r.position for r in p.encode(spark, docs, "").collect()}
