"""SimHash near-dedup with a vantage-point tree over the fingerprints.

A fingerprint has a bit set where over half of the document's word shingles have it set in their XXH64.
Equal fingerprints meet in an aggregate; the rest is a search for pairs of different fingerprints at
``max_bits`` or fewer.

*Tree.* Vantage points come from a bounded sample of the fingerprints (SAMPLE at most, those with the
smallest digest). A node splits by the Hamming distance to its vantage point, near its median and where
the fewest sampled fingerprints lie within ``max_bits`` of the split. The tree has MAX_LEAVES leaves at
most, so the broadcast has a fixed bound; the sample shapes it only, every fingerprint is routed.

*Search.* A fingerprint lives in one leaf, its home. It is also sent to each leaf that its ball of radius
``max_bits`` may reach: by the triangle inequality a branch is pruned when the distance to the vantage point
is off its side by more than the radius. Two fingerprints in reach of each other therefore meet
in the home leaf of either, and the leaves find all pairs exactly. Leaves that are too large for one task
are dealt out in blocks of queries against the residents.

*Components.* A leaf sends a spanning star of what it links, not all pairs, and the alternating-star
rounds join these.

Results for odd input: a null, empty or blank text has fingerprint zero and links like any other; a null
id never gives its name to a component, and a component of null ids only is named null; repeated rows
give repeated results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import Stages
from basketflow.llm.graph import LocalRoots, components

SHINGLE = 3
MAX_BITS = 2
SAMPLE = 65_536
MAX_LEAVES = 16_384
LEAF_TARGET = 2_048  # fingerprints in a leaf, if the number of leaves allows it
BLOCK_PAIRS = 2_000_000_000  # comparisons in one task


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text (signed)."""
    import xxhash
    words = (text or b"").lower().split()  # bytes: only A-Z change
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        bits = np.unpackbits(h[at:at + 8192].astype(">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(h)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text", row_key=None) -> DataFrame:
    """(doc_id, row_key, fp) of every row; ``row_key`` is any column that can be ordered (a null long if not given)."""
    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["doc_id", "row_key", "fp"])

    key = (F.lit(None).cast("long") if row_key is None else row_key).alias("row_key")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), key, F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:2], T.StructField("fp", T.LongType())]))


class Tree:
    """Arrays of nodes: vantage point, split distance, inner and outer child (a leaf as -1 - its number)."""

    def __init__(self, sample: np.ndarray, leaves: int, max_bits: int):
        self.max_bits, self.leaves = max_bits, 0
        self.points, self.splits, self.inner, self.outer = [], [], [], []
        self.root = self._grow(sample, max(1, len(sample) // max(1, leaves)), leaves)

    def _grow(self, sample: np.ndarray, enough: int, leaves: int) -> int:
        best = None
        if leaves > 1 and len(sample) > max(enough, 3):
            for at in np.linspace(0, len(sample) - 1, 5).astype(int):  # a few candidates
                d = np.bitwise_count(sample ^ sample[at]).astype(np.int64)
                count = np.bincount(d, minlength=65)
                upto = np.cumsum(count)
                for r in range(64):
                    if upto[r] * 4 >= len(sample) and upto[r] * 4 <= 3 * len(sample):
                        near = upto[min(64, r + self.max_bits)] - (upto[r - self.max_bits] if r >= self.max_bits else 0)
                        if best is None or near < best[0]:
                            best = (near, at, r, d <= r)
        if best is None:
            self.leaves += 1
            return -self.leaves
        _, at, r, inside = best
        node = len(self.points)
        self.points.append(sample[at])
        self.splits.append(r)
        self.inner.append(0)
        self.outer.append(0)
        self.inner[node] = self._grow(sample[inside], enough, leaves // 2)
        self.outer[node] = self._grow(sample[~inside], enough, leaves - leaves // 2)
        return node

    def route(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into fps, leaf) for all leaves that a ball of this radius may reach; radius 0: the home."""
        rows, leaves, todo = [], [], [(self.root, np.arange(len(fps)))]
        while todo:
            node, idx = todo.pop()
            if not len(idx):
                continue
            if node < 0:
                rows.append(idx)
                leaves.append(np.full(len(idx), -1 - node, np.int32))
                continue
            d = np.bitwise_count(fps[idx] ^ self.points[node]).astype(np.int64)
            todo.append((self.inner[node], idx[d <= self.splits[node] + radius]))
            todo.append((self.outer[node], idx[d > self.splits[node] - radius]))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate(rows), np.concatenate(leaves)


def _link(residents: np.ndarray, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star (as two arrays of fingerprints) of the links between queries and residents."""
    nodes, at = np.unique(np.concatenate([residents, queries]), return_inverse=True)
    mine, theirs = at[:len(residents)], at[len(residents):]
    roots = LocalRoots(len(nodes))
    step = max(1, 4_000_000 // max(1, len(residents)))
    for start in range(0, len(queries), step):
        near = np.bitwise_count(queries[start:start + step, None] ^ residents[None, :]) <= max_bits
        for row in np.flatnonzero(near.any(axis=1)).tolist():
            roots.link(int(theirs[start + row]), mine[near[row]])
    a, b = roots.edges()
    return nodes[a], nodes[b]


def links(fps: DataFrame, stages: Stages, max_bits: int = MAX_BITS, leaf_target: int = LEAF_TARGET, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints (column fp) as their links do."""
    spark = fps.sparkSession
    n = fps.count()
    leaves = int(min(MAX_LEAVES, max(1, n // leaf_target)))
    sample = fps.orderBy(F.xxhash64("fp"), "fp").limit(min(SAMPLE, 16 * leaves)).collect() if leaves > 1 else []
    tree = spark.sparkContext.broadcast(Tree(np.array([r.fp for r in sample], np.int64).view(np.uint64), leaves, max_bits))

    def route(batches):
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            rows, at = tree.value.route(own, max_bits)
            home = np.empty(len(own), np.int32)
            i, leaf = tree.value.route(own, 0)
            home[i] = leaf
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[rows].view(np.int64)), pa.array(home[rows] == at)], names=["leaf", "fp", "home"])

    routed = fps.select("fp").mapInArrow(route, "leaf int, fp long, home boolean")
    # Blocks of queries per leaf, from its counts (at most MAX_LEAVES rows).
    size = routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) * F.sum(F.col("home").cast("double")) / block_pairs).cast("int").alias("blocks"))
    size = stages.write(size, "leaves")
    split = routed.join(size, "leaf").withColumn("blocks", F.greatest("blocks", F.lit(1)))
    query = split.select("leaf", F.pmod(F.xxhash64("fp"), "blocks").cast("int").alias("block"), "fp", F.lit(False).alias("home"))
    resident = split.where("home").select("leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "fp", "home")

    def pairs(table):
        fp, home = table.column("fp").to_numpy().view(np.uint64), table.column("home").to_numpy(zero_copy_only=False).astype(bool)
        a, b = _link(fp[home], fp[~home], max_bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return query.union(resident).groupBy("leaf", "block").applyInArrow(pairs, "a long, b long")


def near_duplicates(docs: DataFrame, stages: Stages, shingle: int = SHINGLE, max_bits: int = MAX_BITS, row_key=None, **options) -> DataFrame:
    """(doc_id, row_key, fp, root, component_id) of every row.

    ``component_id`` is the smallest id reachable by links, ``root`` the smallest fingerprint.
    """
    prints = stages.write(fingerprints(docs, shingle, row_key=row_key), "prints")
    distinct = stages.write(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    joined = components(links(distinct, stages, max_bits, **options), stages)
    rooted = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", "row_key", "fp", "root", "component_id")
