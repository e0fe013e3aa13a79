"""The training-corpus pipeline: quality rules, line dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame; all
but the last return the columns of documents. ``run`` writes each result as Parquet in the shared folder
and reads it back, which cuts the lineage between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import bpe, curriculum, line_dedup, quality, simhash_vp
from basketflow.llm.common import Stages, keyed, place, text_digest


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: rejected documents go.

    A null or empty text is rejected, a null id judged like others; repeated rows share a verdict.
    """
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: repeated line chunks are cut from the texts; documents stay, if need be with an empty text.

    A null text stays null; a null id counts as larger than any other.
    """
    return line_dedup.dedup(docs, Stages(spark, "lines")).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each group the document with the smallest id stays.

    Rows that share an id are told apart by a digest of the text, equal rows and copies without an id by a row number
    (their place in the stage table); one row stays. A group is named by its smallest fingerprint: two groups may hold
    the same smallest id. Null and empty texts are one group; a null id loses to any other.
    """
    stages = Stages(spark, "near")
    rows = keyed(docs, stages)
    texts = rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_row.text").alias("text"), "_n")
    key = F.struct(text_digest(F.col("text")).alias("digest"), F.col("_n").alias("n"))
    found = simhash_vp.near_duplicates(texts, stages, row_key=key)
    last = F.col("doc_id").isNull()
    first = (found.select("root", F.struct(last, "doc_id", "row_key").alias("k"))
             .groupBy("root").agg(F.min("k").alias("k")).select(F.col("k.row_key.n").alias("_n")))
    return rows.join(first, "_n", "left_semi").select("_row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents as often as the mix takes them, in training order.

    A null or empty text has no words and is not taken; a null source is a source; equal rows are placed each.
    """
    return curriculum.mix(docs, Stages(spark, "mix"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: doc_id, source, n_tokens, ids, whether the ids decode to the text, and position.

    The position grows in the order of the rows in the files of ``docs``, which is the training order of the mix.
    """
    import public_tokenizers
    ranks = bpe.read_vocab(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(docs.select("doc_id", "source", "text", place(docs).alias("position")), ranks, public_tokenizers.PATTERN)
    back = bpe.decode(coded, ranks)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return back.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"), "position")


STAGES = [("quality rules", quality_rules), ("line dedup", line_chunks), ("SimHash near-dedup", near_duplicates),
          ("mixing sources", mix), ("byte-level BPE", encode)]

# XXH64 fingerprints, hashed n-grams and BPE ids are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    stages = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stages.write(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            stages.drop(f"stage-{k - 1}")
    return docs
