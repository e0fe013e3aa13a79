"""Quality rules with a hashed n-gram log-likelihood ratio.

Base rules: too few words, or too many words inside repeated three-word windows. Texts that pass are scored:
n-grams of the given orders (words; pairs on request) are hashed to BUCKETS buckets, and two multinomials
are fitted: one to the raw corpus (all documents, add-one smoothing) and one to trusted documents (labelled
quality 1 and not toxic, all of them), smoothed towards the raw one by PRIOR times its own size, so that the ratio does not depend on how much
trusted text there is. A document's score is its mean log ratio of target to raw per n-gram, which does not depend
on its length.

The threshold comes from the trusted documents themselves: they are dealt into two halves by a digest of the id, each
half is scored by the ratios fitted to the other one, and the score that all but QUANTILE of them reach is the
threshold. Documents at or above it stay; no draw is involved.

Everything is DataFrame functions. Judging is a projection: the BUCKETS log ratios are a constant in the
plan, so no text is shuffled and all columns of the input pass through. To fit, each text is measured where it lies;
its id, measures and two bytes per n-gram meet the trusted ids in a shuffle, and what is trusted is written once.

Results for odd input: a null or empty text has no words and fails the base rules; without trusted text in both halves
the base rules alone decide (and without any, every score is 0); null ids are judged like others; repeated rows
are judged alike (each counts in the raw corpus); documents whose scores tie share a verdict; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import Stages, words

BUCKETS = 16_384
PRIOR = 1.0
QUANTILE = 0.005
CELLS = 4_096  # of a unit of score, in which ranks are counted
ORDERS = (1,)
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\f\r"


def _hashed(df: DataFrame, text: str) -> DataFrame:
    """Adds _h (a hash per word) and _pairs (of each word with the next; the last with nothing)."""
    return (df.withColumn("_h", F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
            .withColumn("_pairs", F.transform("_h", lambda h, i: F.xxhash64(h, F.get("_h", i + 1)))))


def _grams(orders) -> list[str]:
    return [{1: "_h", 2: "_pairs"}[n] for n in orders]


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def _counts(buckets: DataFrame) -> list[list[int]]:
    """N-grams per bucket of rows (_by, _b), for each value 0, 1 of ``_by``; at most 2 * BUCKETS rows reach the driver."""
    out = [[0] * BUCKETS, [0] * BUCKETS]
    for r in buckets.select("_by", F.explode("_b").alias("b")).groupBy("_by", "b").count().collect():
        out[r._by][r.b] = r["count"]
    return out


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of the documents labelled good."""
    return labels.where("quality = 1 and coalesce(toxic, 0) <> 1 and doc_id is not null").select("doc_id").distinct()


def quantile(scores: DataFrame, share: float) -> float | None:
    """The percentile of the column ``score``, as Spark's, from counts by cell and the values of the cells it falls in."""
    cell = F.floor(F.col("score") * CELLS)
    cells = scores.where("score is not null").groupBy(cell.alias("cell")).count().orderBy("cell").collect()
    n = sum(r["count"] for r in cells)
    if not n:
        return None
    at = share * (n - 1)
    ranks, found, below = (math.floor(at), math.ceil(at)), [], 0
    for r in cells:
        if below <= ranks[1] and below + r["count"] > ranks[0]:
            seen = below
            for v in scores.where(cell == r["cell"]).groupBy("score").count().orderBy("score").collect():
                found += [v.score for rank in ranks if seen <= rank < seen + v["count"]]
                seen += v["count"]
        below += r["count"]
    return found[0] if ranks[0] == ranks[1] else (ranks[1] - at) * found[0] + (at - ranks[0]) * found[1]


class Model(NamedTuple):
    ratios: list[float]  # the log ratio of every bucket
    threshold: float


def half(doc_id: Column) -> Column:
    """0 or 1: the half of the trusted documents that a document is in."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % 2).cast("int")


def _ratios(target: list[int], raw: list[int]) -> list[float]:
    n_target, n_raw = max(1, sum(target)), sum(raw) + BUCKETS
    share = [(r + 1) / n_raw for r in raw]
    if not any(target):
        return [0.0] * BUCKETS
    return [round(math.log((t / n_target + PRIOR * p) / (1 + PRIOR) / p), 6) for t, p in zip(target, share)]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", orders=ORDERS) -> Model:
    """The log ratio of every bucket and the threshold."""
    stages = Stages(docs.sparkSession, "quality")
    good = stages.write(trusted_ids(labels), "ids")
    buckets = lambda: F.concat(*[F.transform(c, _bucket) for c in _grams(orders)]).cast("array<smallint>").alias("_b")
    measured = measures(docs.select("doc_id", F.col(text).alias("_text")), "_text").select("doc_id", "n_words", _failed(MIN_WORDS).alias("failed"), buckets())
    # Merged at any size: the ids may be too many to broadcast, and the job then needs as much disk a row on small input as on large.
    trusted = measured.join(good.hint("merge"), "doc_id", "left_semi")
    rows = stages.write(trusted.select(half(F.col("doc_id")).alias("_by"), "n_words", "failed", "_b"), "grams")
    halves = _counts(rows)
    raw = _counts(_hashed(docs.select(F.col(text).alias("_text")), "_text").select(F.lit(0).alias("_by"), buckets()))[0]
    ratios = _ratios([a + b for a, b in zip(*halves)], raw)
    if not all(map(any, halves)):
        stages.drop("ids", "grams")
        return Model(ratios, -math.inf)
    held_out = None
    for k in (0, 1):
        score = _total("_b", _ratios(halves[1 - k], raw), lambda b: b) / (len(orders) * F.col("n_words"))
        part = rows.where((F.col("_by") == k) & ~F.col("failed")).select(score.alias("score"))
        held_out = part if held_out is None else held_out.unionByName(part)
    held_out = stages.write(held_out, "scores")
    low = quantile(held_out, QUANTILE)
    stages.drop("ids", "grams", "scores")
    return Model(ratios, -math.inf if low is None else round(low, 6))


def _failed(min_words: int) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _total(grams: str, ratios: list[float], bucket=_bucket) -> Column:
    """The sum of the log ratios of an array of n-grams."""
    constant = F.from_json(F.lit(json.dumps(ratios)), "array<double>")  # folded to a constant
    return F.aggregate(grams, F.lit(0.0), lambda a, h: a + F.get(constant, bucket(h)))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (and hash columns _h, _pairs)."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = _hashed(docs, text)
    n = F.size("_h")
    df = df.withColumn("_lines", F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, _BLANKS, "")) > 0))
    df = df.withColumn("_three", F.when(n > 2, F.transform(F.slice("_pairs", F.lit(1), n - 2), lambda p, i: F.xxhash64(p, F.get("_h", i + 2))))
                       .otherwise(F.array().cast("array<bigint>")))
    # Windows sorted by hash stand next to their equals; only texts that repeat one pay for the sort.
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_three")) < F.size("_three"), F.sort_array(
        F.transform("_three", lambda x, i: F.struct(x.alias("t"), i.alias("i"))))))
    df = df.withColumn("_again", F.sort_array(F.transform(F.filter("_sorted", lambda x, j: (x["t"] == F.get("_sorted", j + 1)["t"]).eqNullSafe(True)
                       | ((j > 0) & (x["t"] == F.get("_sorted", F.greatest(j - 1, F.lit(0)))["t"]))), lambda x: x["i"])))
    covered = F.aggregate(F.transform("_again", lambda x, j: F.least(F.lit(3), F.coalesce(F.get("_again", j + 1), x + 3) - x)),
                          F.lit(0), lambda a, x: a + x)
    return (df.withColumn("n_words", n.cast("long"))
            .withColumn("word_chars", F.length(F.translate(t, _BLANKS, "")).cast("long"))
            .withColumn("n_symbols", (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("_lines", "_three", "_sorted", "_again"))


def judge(docs: DataFrame, model: Model, text: str = "text", min_words: int = MIN_WORDS, orders=ORDERS) -> DataFrame:
    """``docs`` with the measures, base_failed, score (null where base_failed) and kept.

    Columns of ``docs`` with one of these names are replaced.
    To filter by the result use ``keep``, or write it first: a plain filter is pushed below the
    projections and writes out every measure anew at each use.
    """
    df = measures(docs, text).withColumn("base_failed", _failed(min_words))
    total = lambda c: _total(c, model.ratios)
    score = F.when(~F.col("base_failed"), sum(map(total, _grams(orders)[1:]), total(_grams(orders)[0])) / (len(orders) * F.col("n_words")))
    return (df.withColumn("score", score).drop("_h", "_pairs")
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= model.threshold)))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns.

    The whole row travels beside its text, so columns may have any names.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    judged = judge(rows, fit(docs, labels), "_text").select("_row", "kept", F.monotonically_increasing_id().alias("_n"))
    # A filter on _n is not pushed below the projection: pushing would write out every measure anew at each use.
    return judged.where("kept and _n >= 0").select("_row.*")
