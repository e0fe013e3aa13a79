"""Embedding near-dedup with an inverted multi-index.

*Index.* Unit vectors are cut in two halves, each with a codebook of its own (k-means on a bounded sample:
SAMPLE classes with the smallest digest). The pair of nearest codewords is a vector's cell in the product
grid; every vector is indexed. Codebooks have at most MAX_WORDS words, so the broadcast is bounded.

*Traversal.* A query visits cells in the order of the summed squared distances of its halves to the
codewords, by the multi-sequence algorithm (a heap over the two sorted lists), until the sum exceeds that
of its home cell by a slack. The slack is calibrated on the sample: the quantile ``recall`` of what linked
pairs need, over the sample's own linked pairs and over made-up pairs at exactly the threshold, whichever
is larger.

*Verification.* In a cell all visitors are compared with the residents by the dot product of unit
vectors in double precision: no pair below the threshold links. A pair that only one of the two finds
counts for both. Large cells are dealt out in blocks of queries against blocks of residents; a block
returns counts and a spanning star, not pairs. Cells visited are written once, as ids; the vectors join them last.

*Lengths.* Vectors of different lengths never link, so every length has an index of its own: MAX_LENGTHS lengths at
most, the most frequent ones, each with two codebooks. A rarer length, or one that a single cell holds, is one cell:
all its vectors are compared, in blocks, which is exact.

Equal vectors meet first in an aggregate and are one class; their links among each other are counted
from the class size.

Results for odd input: vectors that are null, zero, or hold null or non-finite components link with
nothing (no links, a component of their own). A null id never gives its name to a component. Repeated rows are equal vectors. An empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import Stages
from basketflow.llm.graph import LocalRoots, components

SAMPLE = 20_000
MAX_WORDS = 256
CELL_TARGET = 1_024  # vectors in a cell, if the codebooks' bound allows it
MAX_LENGTHS = 16  # lengths with codebooks; bounds what is broadcast
RECALL = 0.995
BLOCK_RESIDENTS = 4_096
BLOCK_QUERIES = 16_384
_VISIT = "size int, cell int, home int, node binary, n long"


def _prepare(batches):
    """(id, length, node, unit): node is a digest of the vector, null where it can link with nothing."""
    import xxhash
    for batch in batches:
        nodes, units, sizes = [], [], []
        for v in batch.column(1):
            node = unit = size = None
            if v.is_valid:
                x = np.array([np.nan if c is None else c for c in v.as_py()], np.float64) + 0.0
                if len(x) and np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                    scaled = x / top  # no overflow in the norm
                    unit = scaled / np.sqrt(scaled @ scaled)
                    node, size = xxhash.xxh3_128_digest(x.tobytes()), len(x)
            nodes.append(node)
            units.append(unit)
            sizes.append(size)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int32()), pa.array(nodes, pa.binary()), pa.array(units, pa.list_(pa.float64()))],
            names=["vec_id", "size", "node", "unit"])


def _sq(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0.0)


def _codebook(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k-means from evenly spaced rows; empty words keep their place."""
    words = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _sq(x, words).argmin(1)
        total = np.zeros_like(words)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=k)
        words = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], words)
    return words


class Index:
    """Two codebooks and the slack of the traversal."""

    def __init__(self, sample: np.ndarray, k: int, threshold: float, recall: float):
        self.half = sample.shape[1] // 2
        self.books = [_codebook(h, k) for h in (sample[:, :self.half], sample[:, self.half:])]
        self.k = k
        self.slack = self._calibrate(sample, threshold, recall)

    def costs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _sq(x[:, :self.half], self.books[0]), _sq(x[:, self.half:], self.books[1])

    def home(self, costs) -> np.ndarray:
        return costs[0].argmin(1) * self.k + costs[1].argmin(1)

    def excess(self, costs, cells: np.ndarray) -> np.ndarray:
        """What a cell costs each row beyond its home cell."""
        rows = np.arange(len(cells))
        return (costs[0][rows, cells // self.k] + costs[1][rows, cells % self.k]) - (costs[0].min(1) + costs[1].min(1))

    def _calibrate(self, sample, threshold, recall) -> float:
        def needed(x, y):
            cx, cy = self.costs(x), self.costs(y)
            return np.minimum(self.excess(cx, self.home(cy)), self.excess(cy, self.home(cx)))

        some = sample[:4_000]
        a, b = np.nonzero(np.triu(some @ some.T >= threshold, 1))
        need = [0.0]
        if len(a):
            pick = np.linspace(0, len(a) - 1, min(len(a), 50_000)).astype(int)
            need.append(np.quantile(needed(some[a[pick]], some[b[pick]]), recall))
        x = sample[:2_000]
        noise = np.random.default_rng(0).standard_normal(x.shape)
        noise -= (noise * x).sum(1)[:, None] * x
        norm = np.sqrt((noise * noise).sum(1))[:, None]
        y = threshold * x + np.sqrt(max(0.0, 1 - threshold ** 2)) * np.divide(noise, norm, out=np.zeros_like(noise), where=norm > 0)
        need.append(np.quantile(needed(x, y), recall))
        return float(max(need)) + 1e-9

    def visited(self, costs) -> list[list[int]]:
        """Each row's cells by the multi-sequence algorithm, nearest first, up to the slack."""
        out = []
        orders = [c.argsort(1, kind="stable") for c in costs]
        ranked = [np.take_along_axis(c, o, 1) for c, o in zip(costs, orders)]
        for c0, c1, o0, o1 in zip(*(m.tolist() for m in (*ranked, *orders))):
            limit, cells = c0[0] + c1[0] + self.slack, []
            heap, done = [(c0[0] + c1[0], 0, 0)], set()
            while heap and heap[0][0] <= limit:
                _, i, j = heapq.heappop(heap)
                cells.append(o0[i] * self.k + o1[j])
                done.add((i, j))
                if i + 1 < self.k and (j == 0 or (i + 1, j - 1) in done):
                    heapq.heappush(heap, (c0[i + 1] + c1[j], i + 1, j))
                if j + 1 < self.k and (i == 0 or (i - 1, j + 1) in done):
                    heapq.heappush(heap, (c0[i] + c1[j + 1], i, j + 1))
            out.append(cells)
        return out


class OneCell(Index):
    """No codebooks: all vectors share a cell, and all pairs are compared."""

    def __init__(self):
        self.k, self.slack = 1, 0.0

    def costs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros((len(x), 1)), np.zeros((len(x), 1))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _cells(indexes):
    """The cells that each vector visits, without the vector."""
    def run(batches):
        for batch in batches:
            lengths = batch.column("size").to_numpy()
            for size in np.unique(lengths).tolist():
                part = batch.take(pa.array(np.flatnonzero(lengths == size)))
                index = indexes.value.get(size) or OneCell()
                costs = index.costs(_matrix(part.column("unit")))
                home, cells = index.home(costs), index.visited(costs)
                at = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
                flat = np.array([c for own in cells for c in own], np.int32)
                rows = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([rows.column("size"), pa.array(flat), pa.array(home[at].astype(np.int32)), rows.column("node"), rows.column("n")],
                                                 names=["size", "cell", "home", "node", "n"])
    return run


def _verify(indexes, threshold: float):
    types = {"a": pa.binary(), "b": pa.binary(), "n": pa.int64()}

    def run(table):
        """A row (node, root, links) for each node with links found here."""
        cell = table.column("cell")[0].as_py()
        index = indexes.value.get(table.column("size")[0].as_py()) or OneCell()
        lives = table.column("resident").to_numpy(zero_copy_only=False).astype(bool)
        names, at = np.unique(np.array(table.column("node").to_pylist(), "S16"), return_inverse=True)
        names = np.frombuffer(names.tobytes(), "S16") if len(names) else names
        unit, n, home = _matrix(table.column("unit")), table.column("n").to_numpy(), table.column("home").to_numpy()
        data, mine = unit[lives], at[lives]
        ask, theirs, ask_n, ask_home = unit[~lives], at[~lives], n[~lives], home[~lives]
        found, roots = np.zeros(len(names), np.int64), LocalRoots(len(names))
        costs = index.costs(data) if len(data) else None
        for start in range(0, len(ask) if len(data) else 0, 1024):
            part = slice(start, start + 1024)
            near = (ask[part] @ data.T >= threshold) & (theirs[part, None] != mine[None, :])
            np.add.at(found, theirs[part], near @ n[lives])
            # A resident that does not visit the asker's home has no other way to count it.
            asked, hit = np.nonzero(near)
            if len(asked):
                away = ask_home[part][asked] != cell
                a, h = asked[away], hit[away]
                blind = index.excess((costs[0][h], costs[1][h]), ask_home[part][a]) > index.slack
                np.add.at(found, mine[h[blind]], ask_n[part][a[blind]])
            for row in np.unique(asked).tolist():
                roots.link(int(theirs[start + row]), mine[near[row]])
        root = roots.root
        some = np.flatnonzero((found > 0) | (root != np.arange(len(names))))
        pick = lambda idx: pa.array([bytes(names[i]).ljust(16, b"\0") for i in idx.tolist()], pa.binary())
        return pa.table([pick(some), pick(root[some]), pa.array(found[some])], schema=pa.schema(list(types.items())))

    return run


def near_duplicates(vectors: DataFrame, stages: Stages, threshold: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding",
                    recall: float = RECALL, cell_target: int = CELL_TARGET, block_residents: int = BLOCK_RESIDENTS,
                    block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    prepared = stages.write(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector))
                            .mapInArrow(_prepare, "vec_id long, size int, node binary, unit array<double>"), "prepared")
    classes = stages.write(prepared.where("node is not null").groupBy("size", "node", "unit")
                           .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first")), "classes")
    lengths = classes.groupBy("size").count().orderBy(F.desc("count"), "size").limit(MAX_LENGTHS).collect()
    if lengths:
        books = {}
        for size, rows in lengths:
            k = int(min(MAX_WORDS, round((rows / cell_target) ** 0.5)))
            if k > 1:
                sample = classes.where(F.col("size") == size).orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("unit").toArrow()
                books[size] = Index(_matrix(sample.column("unit")), min(k, rows), threshold, recall)
        indexes = spark.sparkContext.broadcast(books)
        visits = stages.write(classes.select("size", "node", "unit", "n").mapInArrow(_cells(indexes), _VISIT), "visits")
        counts = visits.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("visits"), F.sum((F.col("cell") == F.col("home")).cast("long")).alias("lives"))
        counts = stages.write(counts.where("lives > 0").select("size", "cell", F.ceil(F.col("visits") / block_queries).cast("int").alias("qs"),
                                                               F.ceil(F.col("lives") / block_residents).cast("int").alias("ds")), "cells")
        dealt = visits.join(counts, ["size", "cell"])
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        own = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
        ask = dealt.select("size", "cell", own(F.col("qs")).alias("q"), every(F.col("ds")).alias("d"), F.lit(False).alias("resident"), "home", "node", "n")
        live = (dealt.where("cell = home").select("size", "cell", every(F.col("qs")).alias("q"), own(F.col("ds")).alias("d"), F.lit(True).alias("resident"),
                                                  "home", "node", "n"))
        blocks = ask.union(live).join(classes.select("node", "unit"), "node")
        found = blocks.groupBy("size", "cell", "q", "d").applyInArrow(_verify(indexes, threshold), "a binary, b binary, n long")
        found = stages.write(found, "found")
        rooted = components(found.select("a", "b"), stages)
        linked = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
        classes = (classes.select("node", "n", "first").join(linked, "node", "left").join(rooted, "node", "left")
                   .withColumn("root", F.coalesce("root", "node")))
        names = classes.groupBy("root").agg(F.min("first").alias("component_id"))
        classes = classes.join(names, "root").select("node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    else:
        classes = classes.select("node", F.lit(0).cast("long").alias("n_links"), F.col("first").alias("component_id"))
    named = prepared.select("vec_id", "node").join(classes, "node", "left")
    return named.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
