"""The retail view: the given TPC-H style tables seen as an order-history data set.

orders   (order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order)
lines    (order_id, product_id, add_to_cart_order, reordered) plus the header keys
         eval_set, user_id, order_number carried along, since the view joins them anyway
products (product_id, product_name, aisle_id, department_id)

The mapping is fixed by FIXTURES.md; the DuckDB oracle builds the same view in SQL
(basketflow.plans.oracle). Every user's last order is the target: ``train`` or ``test``; all
earlier orders are ``prior``. Test lines are the hidden answer and only the evaluation reads them.

The view can be computed lazily (one plan with the caller's query) or written once as stage
tables under the shared checkpoint folder and read back (``stage=True``), which is what a
pipeline running many queries over one snapshot does.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from basketflow.session import short_shuffles, shuffle_partitions, stage_path
from basketflow.sources.tables import read_table

# Width of a run of order keys in the numbering; then fixed values of the mapping (FIXTURES.md): products a customer chooses from, every how many
# customers share the first of these windows, step between the others, day bucket width, cap of the
# day gap, hours per day, test-user modulus.
KEYS_PER_RUN = 65_536
# Rows that a task of the view sorts and groups, and the fewest worth a task of their own.
ROWS_PER_TASK = 100_000
ROWS_WORTH_A_TASK = 8_192
WINDOW = 50
COMMON = 2
STEP = 37
DAY_BUCKET = 8.0
MAX_GAP = 30.0
HOURS = 24
TEST_MOD = 3


@dataclass
class Retail:
    orders: DataFrame
    lines: DataFrame
    products: DataFrame
    # Partitions that hold the lines by rows, for steps that move all of them; 0 where one task can hold all.
    parts: int = 0

    def lines_of(self, eval_set: str, with_header: bool = False) -> DataFrame:
        """Lines of one evaluation set; 4 columns unless ``with_header`` keeps user_id, order_number."""
        df = self.lines.where(F.col("eval_set") == eval_set)
        cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
        if with_header:
            cols += ["user_id", "order_number"]
        return df.select(*cols)

    @property
    def prior(self) -> DataFrame:
        return self.lines_of("prior")

    @property
    def train(self) -> DataFrame:
        return self.lines_of("train")

    @property
    def test(self) -> DataFrame:
        return self.lines_of("test")


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a number of rows, whatever their size once compressed: adaptive coalescing goes by compressed bytes,
    of which sorts and hash tables take some twenty times as much. 0 where one task can hold all."""
    return 0 if rows <= ROWS_PER_TASK else max(-(-rows // ROWS_PER_TASK), min(-(-rows // ROWS_WORTH_A_TASK), shuffle_partitions(spark)))


def _parts(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Partitions for the rows of a given table (counted from its footers)."""
    return parts_for(spark, read_table(spark, sf_dir, name).count())


def dealt(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``df`` in ``n`` partitions by ``keys``, which adaptive coalescing leaves alone; 0 leaves it as it is."""
    return df.repartition(n, *keys) if n else df


def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])


def build_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders numbered per customer by (o_orderdate, o_orderkey).

    Numbering is blocked by order date and run of order keys (both contiguous in that order): a
    window inside one (customer, date, run) numbers its orders and a window over one summary row per
    block supplies the offset, the customer's total and the previous order date, so a customer
    with a huge share of all orders, even at one date, is never a single task.
    """
    o = _raw_orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), "o_orderdate")
    o = o.withColumn("_run", F.floor(F.col("order_id") / KEYS_PER_RUN))
    block = ["user_id", "o_orderdate", "_run"]
    n = _parts(spark, sf_dir, "orders")
    o = dealt(o, n, *block)
    inside = Window.partitionBy(*block).orderBy("order_id")
    o = o.withColumn("_rn", F.row_number().over(inside))
    blocks = dealt(o.groupBy(*block).agg(F.count(F.lit(1)).alias("_c")), n, "user_id")
    by_block = Window.partitionBy("user_id").orderBy("o_orderdate", "_run")
    blocks = blocks.select(
        *block, F.coalesce(F.sum("_c").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_c").over(Window.partitionBy("user_id")).alias("n_orders"),
        F.lag("o_orderdate").over(by_block).alias("_prev"))
    o = o.join(blocks, block).select(
        "order_id", "user_id", "o_orderdate", (F.col("_off") + F.col("_rn")).alias("order_number"), "n_orders",
        F.when(F.col("_rn") == 1, F.col("_prev")).otherwise(F.col("o_orderdate")).alias("prev_date"))
    gap = F.datediff(F.to_date("o_orderdate"), F.to_date("prev_date"))
    return o.select(
        "order_id",
        "user_id",
        F.when(F.col("order_number") < F.col("n_orders"), "prior")
        .when(F.col("user_id") % TEST_MOD == 0, "test")
        .otherwise("train").alias("eval_set"),
        F.col("order_number").cast("int").alias("order_number"),
        (F.dayofweek("o_orderdate") - 1).cast("int").alias("order_dow"),
        (F.col("order_id") % HOURS).cast("int").alias("order_hour_of_day"),
        F.when(F.col("prev_date").isNull(), F.lit(None).cast("double"))
        .otherwise(F.least(F.lit(MAX_GAP), F.floor(gap / DAY_BUCKET).cast("double")))
        .alias("days_since_prior_order"),
    )


def build_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """One line per (order, product); cart position by first line number; ``reordered`` when the
    customer bought the product in an earlier order.

    The pair's first order_number is a window over its lines: the lines are derived and dealt out once, not a second time
    for an aggregate of them."""
    # A customer chooses from a window of the whole catalogue (repeats need few products per
    # customer). Several line items of an order may fall on one product: keep one line per
    # (order, product) at its first line number.
    n_parts = read_table(spark, sf_dir, "part", ["p_partkey"]).agg(F.count(F.lit(1))).scalar()
    first_part = F.when(F.col("user_id") % COMMON == 0, 0).otherwise(F.col("user_id") * STEP)
    hdr = orders.select("order_id", "user_id", "order_number", "eval_set")
    n = _parts(spark, sf_dir, "lineitem")
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber"]).withColumnRenamed("l_orderkey", "order_id")
    li = (dealt(li, n, "order_id").join(hdr, "order_id")
          .withColumn("product_id", ((first_part + F.col("l_partkey") % WINDOW) % n_parts + 1).cast("int"))
          .groupBy("order_id", "user_id", "order_number", "eval_set", "product_id")
          .agg(F.min("l_linenumber").alias("ln")))
    cart = Window.partitionBy("order_id").orderBy("ln", "product_id")
    joined = li.withColumn("add_to_cart_order", F.row_number().over(cart).cast("int"))
    # A line without a product has its place in the cart but is no line of the view.
    joined = dealt(joined.where(F.col("product_id").isNotNull()), n, "user_id", "product_id")
    with_first = joined.withColumn("_first", F.min("order_number").over(Window.partitionBy("user_id", "product_id")))
    return with_first.select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        F.when(F.col("order_number") > F.col("_first"), 1).otherwise(0).alias("reordered"),
        "eval_set",
        "user_id",
        "order_number",
    )


def build_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_size"])
    return p.select(
        (F.col("p_partkey") + 1).cast("int").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.regexp_replace("p_brand", "Brand#", "").cast("int").alias("aisle_id"),
        (F.col("p_size") % 7 + 1).cast("int").alias("department_id"),
    )


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a Hadoop path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _stage_root(spark: SparkSession, sf_dir: str) -> str:
    """A folder per version of the input: names, sizes and modification times of its files."""
    files = []
    for table in ("orders", "lineitem", "part"):
        fs, path = _hadoop(spark, f"{sf_dir.rstrip('/')}/{table}.parquet")
        found = fs.listFiles(path, True)
        while found.hasNext():
            f = found.next()
            files.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    slug = hashlib.sha1("\n".join(["v5", *sorted(files)]).encode()).hexdigest()[:12]
    return stage_path(spark, "retail_view", slug)


def _read_staged(spark: SparkSession, root: str, parts: int = 0) -> Retail | None:
    for table in ("orders", "lines", "products"):
        fs, done = _hadoop(spark, f"{root}/{table}/_SUCCESS")
        if not fs.exists(done):
            return None  # absent, or left by a write that did not end
    try:
        return Retail(*(spark.read.parquet(f"{root}/{n}") for n in ("orders", "lines", "products")), parts)
    except AnalysisException:
        return None


def load_retail(spark: SparkSession, sf_dir: str, stage: bool = False) -> Retail:
    """The view over ``sf_dir``; ``stage=True`` writes it once to the shared folder and reads it back."""
    parts = _parts(spark, sf_dir, "lineitem")
    if stage:
        root = _stage_root(spark, sf_dir)
        got = _read_staged(spark, root, parts)
        if got is not None:
            return got
    orders = build_orders(spark, sf_dir)
    if not stage:
        return Retail(orders, build_lines(spark, sf_dir, orders), build_products(spark, sf_dir), parts)
    # The lines derive the numbering again: read back, the orders would arrive otherwise, and with them equal lines of
    # repeated order keys.
    with short_shuffles(spark):
        orders.write.mode("overwrite").parquet(f"{root}/orders")
        build_products(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/products")
        # Lines are partitioned by eval_set: the prior / train / test filters become partition pruning.
        (build_lines(spark, sf_dir, orders).write.mode("overwrite")
         .partitionBy("eval_set").parquet(f"{root}/lines"))
    return _read_staged(spark, root, parts)
