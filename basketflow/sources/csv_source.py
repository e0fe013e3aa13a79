"""The order history from its own CSV files (S1-S4): typed or inferred, with a rescue column for fields that do not parse.

Inference reads every column as text and aggregates a type lattice over all rows in one pass: a column is int, long,
double or string, the first that all its values fit (or all but ``tolerance`` of them). Fields that do not fit their
column's type become NULL and are kept, by column, in ``_rescued``; a row with too few or too many fields is kept there
whole. Nothing is dropped, and nothing but one row of counts per file reaches the driver.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.sources.retail_view import Retail, dealt, parts_for
from basketflow.sources.tables import SCHEMAS

# Names of the files of an order history.
FILES = {"orders": "orders.csv", "prior": "order_products__prior.csv", "train": "order_products__train.csv",
         "products": "products.csv", "aisles": "aisles.csv", "departments": "departments.csv"}

RESCUED = "_rescued"
ROW = "_row"
WHOLE = r"^[+-]?[0-9]{1,18}$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
LATTICE = ("int", "bigint", "double", "string")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV file as text, and ``_row``: the line itself where its number of fields is wrong."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(ROW, T.StringType())])
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", ROW).csv(path)


def _fits(value: Column, kind: str) -> Column:
    if kind == "string":
        return F.lit(True)
    if kind == "double":
        return value.rlike(NUMBER)
    whole = F.when(value.rlike(WHOLE), value.try_cast("bigint"))
    return whole.isNotNull() if kind == "bigint" else F.coalesce(whole.between(-2 ** 31, 2 ** 31 - 1), F.lit(False))


def inferred_types(text: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """(column, type, n_values, n_nulls) of every column; rows with a wrong number of fields do not count."""
    columns = [c for c in text.columns if c != ROW]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("v")) for c in columns]))
    values = text.where(F.col(ROW).isNull()).select(each.alias("e")).select("e.*")
    counts = values.groupBy("column").agg(F.count("v").alias("n_values"), F.count_if(F.col("v").isNull()).alias("n_nulls"),
                                          *[F.count_if(F.col("v").isNotNull() & _fits(F.col("v"), k)).alias(k) for k in LATTICE])
    enough = lambda k: F.col(k) >= F.col("n_values") * (1.0 - tolerance)
    kind = F.lit("string")
    for k in reversed(LATTICE[:-1]):
        kind = F.when((F.col("n_values") > 0) & enough(k), F.lit(k)).otherwise(kind)
    return counts.select("column", kind.alias("type"), "n_values", "n_nulls")


def typed(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """The columns cast to their types, with ``_rescued``: column -> field (or ``_row`` -> line) that did not parse, else NULL."""
    whole = F.col(ROW).isNull()
    bad = [F.when(~whole, F.struct(F.lit(ROW).alias("key"), F.col(ROW).alias("value")))]
    out = []
    for c, kind in types.items():
        v = F.col(f"`{c}`")
        fits = _fits(v, kind)
        out.append(F.when(whole & fits, v.try_cast(kind) if kind != "string" else v).alias(c))
        if kind != "string":
            bad.append(F.when(whole & v.isNotNull() & ~fits, F.struct(F.lit(c).alias("key"), v.alias("value"))))
    found = F.filter(F.array(*bad), lambda x: x.isNotNull())
    return text.select(*out, F.when(F.size(found) > 0, F.map_from_entries(found)).alias(RESCUED))


def read_inferred(spark: SparkSession, path: str, tolerance: float = 0.0) -> DataFrame:
    """A CSV file with inferred types and ``_rescued``; one row of counts per column reaches the driver."""
    text = read_text(spark, path)
    found = {r.column: r.type for r in inferred_types(text, tolerance).collect()}
    return typed(text, {c: found.get(c, "string") for c in text.columns if c != ROW})


def read_declared(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A CSV file cast to its declared columns, others left out, with ``_rescued``."""
    schema = SCHEMAS[kind]
    return typed(read_text(spark, path), {f.name: f.dataType.simpleString() for f in schema.fields})


def load_csv(spark: SparkSession, folder: str) -> Retail:
    """The order history of a folder of CSV files: orders, lines (prior and train) with their header, products.

    A file may be a folder of part files of that name. Rows with a field that does not parse are refused with their
    number, since a history without them would be another one; ``rescued`` shows them. Test orders have no lines.
    The pass that looks for them counts the rows too, by which lines and orders are dealt out to meet.
    """
    at = lambda name: os.path.join(folder, FILES[name])
    found = _each_file(spark, folder).groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size(F.coalesce(RESCUED, F.create_map()))).alias("bad")).collect()
    counts = {r.file: r.bad for r in found if r.bad}
    if counts:
        raise ValueError(f"rows that do not parse: {counts}")
    n = parts_for(spark, sum(r.rows for r in found if r.file in (FILES["prior"], FILES["train"])))
    orders = read_declared(spark, at("orders"), "orders").drop(RESCUED)
    lines = read_declared(spark, at("prior"), "lines").unionByName(read_declared(spark, at("train"), "lines")).drop(RESCUED)
    header = orders.select("order_id", "eval_set", "user_id", "order_number")
    lines = dealt(lines, n, "order_id").join(dealt(header, n, "order_id"), "order_id")
    products = read_declared(spark, at("products"), "products").drop(RESCUED)
    return Retail(orders, lines, products, n)


def rescued(spark: SparkSession, folder: str) -> DataFrame:
    """(file, field, value): every field and row of the history that does not parse."""
    return _each_file(spark, folder).where(F.col(RESCUED).isNotNull()).select("file", F.explode(RESCUED).alias("field", "value"))


def _each_file(spark: SparkSession, folder: str) -> DataFrame:
    """(file, _rescued): every row of the history."""
    out = None
    for name, kind in (("orders", "orders"), ("prior", "lines"), ("train", "lines"), ("products", "products")):
        part = read_declared(spark, os.path.join(folder, FILES[name]), kind).select(F.lit(FILES[name]).alias("file"), RESCUED)
        out = part if out is None else out.unionByName(part)
    return out


def write_history(retail: Retail, folder: str) -> None:
    """The six CSV files of a history (test lines, which a history does not show, are left out)."""
    from basketflow.sources.stage import write_csv
    four = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    number = lambda c: retail.products.select(c).distinct()
    tables = {"orders": retail.orders, "prior": retail.prior.select(*four), "train": retail.train.select(*four), "products": retail.products,
              "aisles": number("aisle_id").withColumn("aisle", F.concat(F.lit("aisle "), F.col("aisle_id"))),
              "departments": number("department_id").withColumn("department", F.concat(F.lit("department "), F.col("department_id")))}
    for name, df in tables.items():
        write_csv(df, os.path.join(folder, FILES[name]))
