"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order (null last) take the given weights in turn and share
``share`` times all words; no source gets more than ``max_repeat`` times its own words, and what
that leaves is shared again by weight. The water level is found by a few rounds of one small aggregate
each; only scalars reach the driver.

Order: each source's documents follow a digest of their id, a fixed shuffle (without an id: of their size and
further columns, so that many null ids are many blocks). A document's place in the
source's word stream is a running sum, taken in two steps: inside blocks of the digest (so that a source
with a third of all rows is many bounded tasks) and over one row per block.

Positions: source s has a weight schedule w_s(t), linear from ``start`` to ``end`` over the training
run t in [0, 1]. Its integral, scaled to the source's target, is the source's cumulative token demand;
the copy of a document in the middle of demand u gets the t at which that integral reaches u (a
quadratic, solved in closed form). Sorting all copies by t by range gives the training order.

Documents are taken whole: target // source words full passes, and in the last pass the documents whose
middle lies below what is left, so a source misses its target by half a document at most.

Results for odd input: a null or empty text has size 0 and is never taken; a null source is a source;
a null id is an id; repeated rows stand side by side in the order, each with its own part of the stream;
an empty table gives an empty result; a source without words has target 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.common import PLACE_BITS, Stages, keyed, place, words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
# (start, end) of a source's weight over the run, in turn like the weights.
SCHEDULES = ((2.0, 1.0), (1.0, 1.0), (1.0, 3.0))
ROWS_PER_BLOCK = 50_000


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT,
            schedules=SCHEDULES, stages: Stages | None = None) -> DataFrame:
    """source, source_size, target, start, end from rows (source, size).

    With ``stages`` the sums by source are written once, and the rounds read them instead of the rows.
    """
    # One row per source: the number of sources, not of documents, bounds this window.
    by_source = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                 .withColumn("turn", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1))

    def in_turn(values) -> Column:
        return F.array(*[F.lit(float(v)) for v in values])[F.pmod("turn", F.lit(len(values)))]

    by_source = by_source.select("source", "source_size", in_turn(weights).alias("weight"),
                                 in_turn([a for a, _ in schedules]).alias("start"),
                                 in_turn([b for _, b in schedules]).alias("end"))
    by_source = stages.write(by_source, "by_source") if stages else by_source
    cap = F.lit(float(max_repeat)) * F.col("source_size")
    total, weight = by_source.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (total or 0)
    level = wanted / weight if weight else 0.0
    while True:  # each round caps at least one more source, or ends
        below = F.lit(level) * F.col("weight") < cap
        capped, open_weight = by_source.agg(F.sum(F.when(~below, cap)), F.sum(F.when(below, F.col("weight")))).first()
        if not open_weight:
            level = math.inf
            break
        new = (wanted - (capped or 0.0)) / open_weight
        if new <= level:
            break
        level = new
    target = cap if math.isinf(level) else F.least(cap, F.lit(level) * F.col("weight"))
    return by_source.select("source", "source_size", target.alias("target"), "start", "end")


def _position(u: Column) -> Column:
    """The t in [0, 1] at which the integral of the linear weight reaches the share ``u`` of the whole."""
    a, b = F.col("start"), F.col("end")
    return F.when(a == b, u).otherwise((F.sqrt(a * a + (b - a) * (a + b) * u) - a) / (b - a))


def plan(sizes: DataFrame, stages: Stages, rows_per_block: int = ROWS_PER_BLOCK, **options) -> DataFrame:
    """Rows (doc_id, source, size, ...) with source_size, target, taken and positions (one per copy)."""
    keep = [c for c in sizes.columns if c not in ("doc_id", "source", "size")]
    shuffled = F.coalesce(F.col("doc_id").cast("string"), F.xxhash64("size", *keep).cast("string"))
    sizes = stages.write(sizes.withColumn("_order", F.md5(shuffled.cast("binary"))), "sizes")
    goals = stages.write(targets(sizes, stages=stages, **options), "targets")
    digits = max(1, math.ceil(math.log(max(1, sizes.count() / rows_per_block), 16)))
    sizes = sizes.withColumn("_block", F.substring("_order", 1, digits))
    blocks = (sizes.groupBy("source", "_block").agg(F.sum("size").alias("_words"))
              .withColumn("_before", F.coalesce(F.sum("_words").over(
                  Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    inside = Window.partitionBy("source", "_block").orderBy("_order", "size", *keep).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sizes.withColumn("_upto", F.sum("size").over(inside))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    b, g = blocks.alias("b"), goals.alias("g")
    placed = (placed.alias("p").join(b, same(placed, blocks) & (placed["_block"] == blocks["_block"]))
              .select("p.*", F.col("b._before").alias("_before")))
    placed = (placed.alias("p").join(g, F.col("p.source").eqNullSafe(F.col("g.source")))
              .select("p.*", "g.source_size", "g.target", "g.start", "g.end"))
    middle = F.col("_before") + F.col("_upto") - F.col("size") / 2  # of the document, in the source's word stream
    passes = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - passes * F.col("source_size")
    copies = F.when(F.col("size") > 0, passes + (middle < rest).cast("long")).otherwise(F.lit(0)).cast("long")
    u = lambda k: F.least(F.lit(1.0), (k * F.col("source_size") + middle) / F.col("target"))
    at = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), lambda k: _position(u(k))))
    return (placed.withColumn("copies", copies)
            .select("doc_id", "source", "size", *keep, "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                    "copies", F.coalesce(at, F.array().cast("array<double>")).alias("positions")))


def doc_sizes(docs: DataFrame, *more) -> DataFrame:
    return docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), *more)


def training_order(sizes: DataFrame, stages: Stages, **options) -> DataFrame:
    """(doc_id, source, size, copy, position, rank) of every copy that the mix takes; ranks from 0 without gaps.

    The copies are range-sorted and written; a copy's rank is its row in its file plus the rows of the files before.
    """
    copies = plan(sizes, stages, **options).select("doc_id", "source", "size", F.posexplode("positions").alias("copy", "position"))
    order = ("position", "doc_id", "copy")
    written = stages.write(copies.withColumn("copy", F.col("copy").cast("long")).repartitionByRange(*order).sortWithinPartitions(*order), "order")
    placed = written.withColumn("_place", place(written))
    placed = placed.withColumn("_file", F.shiftright("_place", PLACE_BITS))
    # One row per file, not per copy, bounds this window.
    before = (placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
              .select("_file", F.coalesce(F.sum("_rows").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")))
    rank = F.col("_before") + F.col("_place").bitwiseAND(F.lit(2 ** PLACE_BITS - 1))
    return placed.join(before, "_file").select("doc_id", "source", "size", "copy", "position", rank.alias("rank"))


def mix(docs: DataFrame, stages: Stages, **options) -> DataFrame:
    """The mixed documents, one row per copy, range-sorted by training position; columns as given.

    Rows without words are not taken. Rows are matched to their plan one to one by a number of their own, so
    that equal rows and copies without an id are spread like any others.
    """
    rows = keyed(docs, stages)
    sizes = doc_sizes(rows.select(*[F.col(f"_row.{c}").alias(c) for c in ("doc_id", "source", "text")], "_n"), "_n")
    copies = plan(sizes, stages, **options).select("_n", F.explode("positions").alias("_position"))
    return (rows.join(copies, "_n").repartitionByRange("_position", "_n").sortWithinPartitions("_position", "_n")
            .select("_row.*"))
