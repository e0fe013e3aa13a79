"""The quality model is fitted to every trusted document."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketflow.llm import quality as ql


def test_all_trusted_documents_count(spark):
    """One word stands only in trusted documents beyond the 20,000 that used to be taken."""
    labels = spark.range(25_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert ql.trusted_ids(labels.unionByName(labels)).count() == 25_000
    docs = labels.select("doc_id", F.concat(F.lit("w"), "doc_id").alias("text"))
    model = ql.fit(docs, labels)
    # Target and raw text are the same, so that the ratio differs from 0 by the smoothing only.
    raw = [0] * ql.BUCKETS
    for r in docs.select(F.pmod(F.xxhash64("text"), F.lit(ql.BUCKETS)).alias("b")).groupBy("b").count().collect():
        raw[r.b] = r["count"]
    assert model.ratios == ql._ratios(raw, raw)


def test_quantile_as_percentile(spark):
    scores = spark.range(1_000).select(F.when(F.col("id") % 7 > 0, F.sin("id") * 3 + F.floor(F.col("id") / 400)).alias("score"))
    for share in (0.0, 0.005, 0.37, 0.5, 1.0):
        assert abs(ql.quantile(scores, share) - scores.agg(F.percentile("score", share)).first()[0]) < 1e-12
    assert ql.quantile(scores.where("false"), 0.5) is None


def test_no_text_meets_the_trusted_ids(spark, monkeypatch):
    """Whatever the number of ids, only ids, measures and buckets are shuffled."""
    docs = spark.createDataFrame([(i, "a b c " * (20 + i)) for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    plans, write = {}, ql.Stages.write

    def spy(self, df, table):
        plans[table] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(self, df, table)

    monkeypatch.setattr(ql.Stages, "write", spy)
    model = ql.fit(docs, labels)
    join = plans["grams"][plans["grams"].index("Join LeftSemi"):].splitlines()
    assert "rightHint=(strategy=merge)" in join[0]
    sent = next(line.lstrip("+-: ") for line in join[1:] if "Project" in line)
    assert sent.startswith("Project [doc_id") and "AS _b#" in sent and "AS _text#" not in sent
    assert len(model.ratios) == ql.BUCKETS
