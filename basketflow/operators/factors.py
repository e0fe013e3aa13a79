"""User factors from reordered-product counts (M3, M4) and their input.

The user x product matrix stays in coordinate form (user_id, product_id, cnt); the reference's
per-user lists and CSR matrix are only a container for these coordinates.
"""

from __future__ import annotations

import math
import sys
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.sources.retail_view import Retail
from basketflow.sources.stage import Scratch

# The grouped / batch functions of this module run in Python workers: ship them by value so the
# workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def reordered_history(r: Retail) -> DataFrame:
    """For each target order, the products its user reordered in prior orders, with multiplicity.

    J5 (target order x the user's prior orders) and J6 (x their lines) collapse into one join on
    user_id, since prior lines already carry user_id; the counts are aggregated per pair before
    the join, so no list of lines is ever gathered.
    """
    targets = r.orders.where(F.col("eval_set") != "prior").select("order_id", "user_id", "order_number")
    counts = (r.lines_of("prior", with_header=True).where(F.col("reordered") == 1)
              .groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("n_times")))
    x = targets.join(counts, "user_id")
    total = counts.groupBy("user_id").agg(F.sum("n_times").cast("long").alias("num_products_reordered"))
    return x.join(total, "user_id").select("order_id", "user_id", "order_number", "product_id", "n_times", "num_products_reordered")


# ---------------------------------------------------------------- M3 / M4: non-negative factors

# Fixed values of the factorisation: number of components, random seed.
N_COMPONENTS = 100
SEED = 42
EPS = 1e-10
# The loss has converged when a round takes less than this share of the first loss off it.
TOLERANCE = 5e-4
# Columns of the block behind the SVD start besides the components.
MORE = 10
MAX_ITERATIONS = 200


def reorder_counts(r: Retail) -> DataFrame:
    """The user x product matrix X in coordinates: (user_id, product_id, cnt) of reordered prior lines,
    for every user with a target order."""
    h = reordered_history(r)
    return h.select("user_id", "product_id", F.col("n_times").cast("double").alias("cnt"))


def _matrix(column) -> "np.ndarray":
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _gram_partials(k: int):
    """V'V of each partition's vectors (column 0)."""
    import numpy as np
    import pyarrow as pa

    def fn(batches):
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column(0))
                total += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["g"])

    return fn


# Rows of a side that a tile of the matrix covers, tiles a side is cut into where it has rows for them, rows whose sums one task adds up,
# bytes of vectors and sums that are worth a shuffle of their own.
BAND_ROWS = 131_072
BANDS = 4
SUM_ROWS = 8_192
PASS_BYTES = 2 ** 29


def bands(n: int, slices: int = 1) -> int:
    """Bands of a side with ``n`` rows, multiplied in ``slices`` of columns."""
    return max(1, -(-n // (BAND_ROWS * slices)), min(BANDS, -(-n // SUM_ROWS)))


def slices(n_rows: int, n_cols: int, k: int) -> int:
    """Slices of columns that a block of ``k`` is multiplied in, one after the other, by a matrix of this size.

    One where all that moves is little. A vector moves once per band of the other side, and a band has as many more rows as
    a slice has less columns; the coordinates move once per slice: with the root of the bands both grow alike."""
    moved = BANDS * (n_rows + n_cols) * k * 8
    return max(1, min(-(-moved // PASS_BYTES), max(2 * BANDS, math.ceil(2 * math.sqrt(max(n_rows, n_cols) / BAND_ROWS)))))


def _listed(rows: "np.ndarray"):
    """The rows of a matrix as an Arrow list column."""
    import numpy as np
    import pyarrow as pa
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype="int32")), pa.array(rows.ravel()))


def _tile_sums(to: str, on: str, k: int, step: int = 16_384):
    """A tile's coordinates and the vectors of its ``on`` side -> (part, key, v): per key of the ``to`` side, the sum of
    value times vector over the tile."""
    import numpy as np
    import pyarrow as pa

    def fn(key, coordinates, vectors):
        keys = vectors.column("key").to_numpy()
        rows, cols = coordinates.column(to).to_numpy(), coordinates.column(on).to_numpy()
        values = coordinates.column("value").to_numpy()
        order = np.argsort(keys, kind="stable")
        at = np.minimum(np.searchsorted(keys, cols, sorter=order), max(0, len(keys) - 1))
        at = order[at] if len(keys) else at
        met = np.flatnonzero(keys[at] == cols) if len(keys) else np.zeros(0, int)
        met = met[np.lexsort((cols[met], rows[met]))]
        found, place = np.unique(rows[met], return_inverse=True)
        out = np.zeros((len(found), k))
        if len(met):
            v = _matrix(vectors.column("v").combine_chunks())
            for a in range(0, len(met), step):
                part, row = met[a:a + step], place[a:a + step]
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                out[row[first]] += np.add.reduceat(values[part][:, None] * v[at[part]], first, axis=0)
        band = key[0 if on == "row" else 1].as_py()
        return pa.table([pa.array(np.full(len(found), band, "int32")), pa.array(found), _listed(out)], names=["part", "key", "v"])

    return fn


def _added_up(k: int):
    """Rows (part, key, v) of whole keys -> (key, sum of v), added in the order of the parts."""
    import numpy as np
    import pyarrow as pa

    def fn(batches):
        parts, keys, vectors = [], [], []
        for batch in batches:
            if batch.num_rows:
                parts.append(batch.column(0).to_numpy())
                keys.append(batch.column(1).to_numpy())
                vectors.append(_matrix(batch.column(2)))
        if keys:
            part, key, v = np.concatenate(parts), np.concatenate(keys), np.concatenate(vectors)
            order = np.lexsort((part, key))
            key = key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            yield pa.RecordBatch.from_arrays([pa.array(key[first]), _listed(np.add.reduceat(v[order], first, axis=0))], names=["key", "v"])

    return fn


def _side_by_side(k: int):
    """Rows (at, key, v) of whole keys, each a slice of columns from ``at`` -> (key, v of ``k`` columns)."""
    import numpy as np
    import pyarrow as pa

    def fn(batches):
        found = [(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)) for batch in batches if batch.num_rows]
        if found:
            keys, place = np.unique(np.concatenate([key for _, key, _ in found]), return_inverse=True)
            out = np.zeros((len(keys), k))
            a = 0
            for at, key, v in found:
                mine = place[a:a + len(key)]
                a += len(key)
                offsets, flat = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False)
                for start in np.unique(at):
                    rows = np.flatnonzero(at == start)
                    width = offsets[rows[0] + 1] - offsets[rows[0]]
                    out[mine[rows], start:start + width] = flat[offsets[rows][:, None] + np.arange(width)]
            yield pa.RecordBatch.from_arrays([pa.array(keys), _listed(out)], names=["key", "v"])

    return fn


class Tiles:
    """A sparse matrix (row, col, value) in tiles of a band of rows and a band of columns, to be multiplied by blocks of vectors.

    A vector goes to the tiles of its band and a tile sends one sum per row it has, so what moves is (bands of both
    sides) x vectors, not a vector per coordinate; a task holds one tile with the vectors of its two bands. A large block
    (of up to ``k`` columns) is multiplied in slices of its columns, each written before the next: disk holds the shuffle of
    one slice.
    """

    def __init__(self, coordinates: DataFrame, n_rows: int, n_cols: int, k: int = 0):
        self.sizes = {"row": n_rows, "col": n_cols}
        self.slices = slices(n_rows, n_cols, k)
        self.types = {c: coordinates.schema[c].dataType.simpleString() for c in ("row", "col")}
        self.coordinates = coordinates.select(self._band("row", "row").alias("_row"), self._band("col", "col").alias("_col"), "row", "col", "value")

    def _band(self, side: str, key: str):
        return F.pmod(F.hash(key), F.lit(self.bands(side)))

    def bands(self, side: str) -> int:
        return bands(self.sizes[side], self.slices)

    def times(self, block: DataFrame, on: str, k: int) -> DataFrame:
        """(key, v): the matrix (``on`` "col") or its transpose ("row") times the block (key, v); rows without an entry are absent."""
        to = "row" if on == "col" else "col"
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(self.bands(to) - 1))).alias(f"_{to}")
        sent = block.select(everywhere, self._band(on, "key").alias(f"_{on}"), "key", "v")
        partial = self.coordinates.groupBy("_row", "_col").cogroup(sent.groupBy("_row", "_col")).applyInArrow(
            _tile_sums(to, on, k), f"part int, key {self.types[to]}, v array<double>")
        return partial.repartition(max(1, -(-self.sizes[to] // (SUM_ROWS * self.slices))), "key").mapInArrow(
            _added_up(k), f"key {self.types[to]}, v array<double>")

    @contextmanager
    def product(self, block: DataFrame, on: str, k: int, scratch: Scratch, spent: bool = False):
        """``times`` slice by slice, to be read inside; ``spent``: the block is a table of ``scratch`` that nothing else reads."""
        if self.slices == 1:
            yield self.times(block, on, k)
        else:
            to = "row" if on == "col" else "col"
            step = -(-k // self.slices)
            each = [self.times(block.select("key", F.slice("v", a + 1, step).alias("v")), on, min(step, k - a)).select(F.lit(a).alias("at"), "key", "v")
                    for a in range(0, k, step)]
            parts = scratch.keep(*each)
            if spent:
                scratch.drop(block)
            yield parts.repartition(-(-self.sizes[to] // SUM_ROWS), "key").mapInArrow(_side_by_side(k), f"key {self.types[to]}, v array<double>")
            scratch.drop(parts)
        if spent:
            scratch.drop(block)


def _updated(gram, eps: float):
    """Rows (key, v, numerator): v <- v * numerator / (v gram + eps)."""
    import pyarrow as pa

    def fn(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v, n = _matrix(batch.column(1)), _matrix(batch.column(2))
            new = v * n / (v @ gram + eps)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(new), pa.list_(pa.float64())), batch.column(2)], names=["key", "v", "n"])

    return fn


def _swept(gram):
    """Rows (key, v, numerator): one sweep of coordinate descent, v_t <- max(0, v_t + (n_t - v gram_t) / gram_tt) for t in turn."""
    import numpy as np
    import pyarrow as pa

    def fn(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v, n = _matrix(batch.column(1)).copy(), _matrix(batch.column(2))
            for t in range(gram.shape[0]):
                if gram[t, t] > 0.0:
                    v[:, t] = np.maximum(0.0, v[:, t] + (n[:, t] - v @ gram[:, t]) / gram[t, t])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(v), pa.list_(pa.float64())), batch.column(2)], names=["key", "v", "n"])

    return fn


def times(m):
    """Rows (key, v) -> (key, v m)."""
    import numpy as np
    import pyarrow as pa

    def fn(batches):
        for batch in batches:
            if batch.num_rows:
                out = _matrix(batch.column(1)) @ m
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, m.shape[1], dtype="int32")), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["key", "v"])

    return fn


def _one_sign(factor):
    """Rows (key, v) -> (key, max(0, v * factor)): the chosen sign of each column, scaled."""
    import numpy as np
    import pyarrow as pa

    def fn(batches):
        for batch in batches:
            if batch.num_rows:
                out = np.maximum(0.0, _matrix(batch.column(1)) * factor)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(out), pa.list_(pa.float64()))], names=["key", "v"])

    return fn


def inverse_root(gram):
    """The matrix that makes a block with this Gram matrix orthonormal; its null directions become zero."""
    import numpy as np
    size, axes = np.linalg.eigh(gram)
    good = size > max(size[-1], 0.0) * 1e-14
    return axes * np.where(good, 1.0 / np.sqrt(np.where(good, size, 1.0)), 0.0)


def _sign_norms(side: DataFrame, k: int):
    """(2, k): the length of the positive and of the negative part of each column."""
    import numpy as np
    v = lambda i: F.col("v")[i]
    parts = [F.sum(F.pow(F.greatest(s * v(i), F.lit(0.0)), F.lit(2))).alias(f"c{j}_{i}") for j, s in enumerate((1.0, -1.0)) for i in range(k)]
    return np.sqrt(np.array(side.agg(*parts).first(), float)).reshape(2, k)


def svd_start(k: int, keys: DataFrame, tiles: Tiles, gram, types: dict, scratch: Scratch, power: int = 2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Non-negative start factors (key, v) of both sides from the leading singular vectors (Boutsidis and Gallopoulos, 2008).

    ``tiles`` holds X, of which ``keys`` are the products. A block of hashed vectors is multiplied to and fro (randomised range finder); the driver sees
    Gram matrices and the lengths of each column's positive and negative part, of which the larger pair is kept.
    """
    import numpy as np
    size = k + MORE
    uniform = lambda j, i: F.pmod(F.xxhash64("key", j, F.lit(i + seed * 16)), F.lit(1_000_003)).cast("double") / 1_000_003 - 0.5
    block = scratch.keep(keys.withColumn("v", F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: uniform(j, 0) + uniform(j, 1) + uniform(j, 2))))
    schema = lambda side: f"key {types[side]}, v array<double>"

    def multiplied(block: DataFrame, on: str, spent: bool) -> DataFrame:
        with tiles.product(block, on, size, scratch, spent) as product:
            return scratch.keep(product)

    for _ in range(power):
        image = multiplied(multiplied(block, "col", True), "row", True)
        block = scratch.keep(image.mapInArrow(times(inverse_root(gram(image, size))), schema("h")))
        scratch.drop(image)
    image = multiplied(block, "col", False)
    level, axes = np.linalg.eigh(gram(image, size))
    first = np.argsort(-level, kind="stable")[:k]
    level, axes = np.sqrt(np.maximum(level[first], 0.0)), axes[:, first]
    inverse = np.where(level > 1e-9 * max(level[0], 1e-300), 1.0 / np.maximum(level, 1e-300), 0.0)
    u = scratch.keep(image.mapInArrow(times(axes * inverse), schema("w")))
    v = scratch.keep(block.mapInArrow(times(axes), schema("h")))
    scratch.drop(image, block)
    of_u, of_v = _sign_norms(u, k), _sign_norms(v, k)
    both = of_u * of_v
    sign = np.where(both[0] >= both[1], 1.0, -1.0)
    pick = (both[0] < both[1]).astype(int)
    at = np.arange(k)
    scale = np.sqrt(level * both[pick, at])

    def factor(norms):
        length = norms[pick, at]
        return sign * np.where(length > 0, scale / np.where(length > 0, length, 1.0), 0.0)

    w = scratch.keep(u.mapInArrow(_one_sign(factor(of_u)), schema("w")))
    h = scratch.keep(v.mapInArrow(_one_sign(factor(of_v)), schema("h")))
    scratch.drop(u, v)
    return w, h


def user_factors(x: DataFrame, k: int = N_COMPONENTS, iterations: int = MAX_ITERATIONS, seed: int = SEED, tolerance: float = TOLERANCE,
                 w_init: DataFrame | None = None, h_init: DataFrame | None = None, solver: str = "mu", scratch: Scratch | None = None):
    """M3: X ~ W H with W, H >= 0 (Frobenius loss), by Lee-Seung multiplicative updates (``solver`` "mu") or by sweeps of
    coordinate descent from an SVD-based start ("cd"), which take fewer rounds.

    X is a coordinate DataFrame (user_id, product_id, cnt); W (user_id, w) and H (product_id, h) are
    DataFrames with one array of k per row. X is kept in tiles of users and products, so
    it moves once; a half-step sends the other side's vectors to the tiles, sums inside them in numpy
    and shuffles vectors only. The driver sees k x k Gram matrices. W and H
    are written to ``scratch`` (a folder of its own) in each round, and the round before goes. Rounds end when the loss falls by less
    than ``tolerance`` of its first value, or after ``iterations``. Returns (W, H, losses);
    ``w_init`` and ``h_init`` replace the start, which is a hash of (key, component) for "mu".
    """
    import numpy as np
    from pyspark import StorageLevel
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    spark = x.sparkSession
    scratch = scratch or Scratch(spark, "factors")
    x = scratch.keep(x.select("user_id", "product_id", F.col("cnt").cast("double").alias("cnt")))
    count, mean, x_sq = x.agg(F.count(F.lit(1)), F.avg("cnt"), F.sum(F.col("cnt") * F.col("cnt"))).first()

    def start(column: str, scale: float, salt: int) -> DataFrame:
        part = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.pmod(
            F.xxhash64(F.col("key"), j, F.lit(salt)), F.lit(1_000_000)).cast("double") / 1e6 * 2 * scale + 1e-3 * scale)
        return x.select(F.col(column).alias("key")).distinct().withColumn("v", part)

    if not count:
        empty = "array<double>"
        return (spark.createDataFrame([], f"user_id long, w {empty}"), spark.createDataFrame([], f"product_id int, h {empty}"), [])
    n_users, n_products = (x.select(c).distinct().count() for c in ("user_id", "product_id"))
    # Random start as in common practice: scale sqrt(mean(X) / k), the mean over the full matrix.
    scale = float(np.sqrt(mean * count / (n_users * n_products) / k))
    tiles = Tiles(x.select(F.col("user_id").alias("row"), F.col("product_id").alias("col"), F.col("cnt").alias("value")), n_users, n_products, k + MORE)
    tiles.coordinates = tiles.coordinates.repartition(tiles.bands("row") * tiles.bands("col"), "_row", "_col").persist(StorageLevel.MEMORY_AND_DISK)
    key_types = {"w": x.schema["user_id"].dataType.simpleString(), "h": x.schema["product_id"].dataType.simpleString()}

    def gram(side: DataFrame, k: int = k):
        partial = side.select("v").mapInArrow(_gram_partials(k), "g array<double>")
        total = partial.select(array_to_vector("g").alias("g")).agg(Summarizer.sum(F.col("g")).alias("s")).first()
        return np.asarray(total["s"].toArray()).reshape(k, k)

    if solver == "cd" and w_init is None and h_init is None:
        w, h = svd_start(k, x.select(F.col("product_id").alias("key")).distinct(), tiles, gram, key_types, scratch, seed=seed)
    else:
        w = scratch.keep(start("user_id", scale, seed) if w_init is None else w_init.toDF("key", "v"))
        h = scratch.keep(start("product_id", scale, seed + 1) if h_init is None else h_init.toDF("key", "v"))
    # A row's share of <W, X H'>.
    dot = F.aggregate(F.zip_with("v", "n", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)

    def half_step(target: DataFrame, kind: str, other: DataFrame, on: str, g):
        """(key, v, dot) of the updated side; dot is v times its row of X times the other side."""
        with tiles.product(other.select("key", "v"), on, k, scratch) as product:
            new = (target.select("key", "v").join(product.withColumnRenamed("v", "n"), "key")
                   .mapInArrow(_updated(g, EPS) if solver == "mu" else _swept(g), f"key {key_types[kind]}, v array<double>, n array<double>"))
            new = scratch.keep(new.select("key", "v", dot.alias("dot")))
        scratch.drop(target)
        return new

    losses: list[float] = []
    for _ in range(iterations):
        h = half_step(h, "h", w, "row", gram(w))
        hht = gram(h)
        w = half_step(w, "w", h, "col", hht)
        # ||X - WH||^2 = ||X||^2 - 2 <W, X H'> + <W'W, HH'>
        cross = w.agg(F.sum("dot")).first()[0] or 0.0
        losses.append(float(x_sq - 2 * cross + np.sum(gram(w) * hht)))
        if len(losses) > 1 and losses[-2] - losses[-1] < tolerance * losses[0]:
            break
    tiles.coordinates.unpersist()
    return (w.select(F.col("key").alias("user_id"), F.col("v").alias("w")),
            h.select(F.col("key").alias("product_id"), F.col("v").alias("h")), losses)


def normalize_rows(w: DataFrame) -> DataFrame:
    """M4: L2-normalise each user's factor row; an all-zero row stays zero."""
    norm = F.sqrt(F.aggregate("w", F.lit(0.0), lambda acc, v: acc + v * v))
    return w.select("user_id", F.when(norm > 0, F.transform("w", lambda v: v / norm))
                    .otherwise(F.col("w")).alias("factors"))
