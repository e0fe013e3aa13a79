r"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once, with that speaker as the assistant
and all others as named users; the mask lists the character ranges to learn from: the assistant's
texts with their end marks. Roles in NOT_SPEAKERS are shown to everyone as they are and have no perspective.

A dialogue comes in rows of bounded size: turns are cut into runs of TURNS, and a run in which more than
MOST messages share few turns is cut further, by turn and by digest. Usual conversations are one row; one
that holds a third of all messages is many, each with its place (``block``) and its offset in the whole
(``start``), found from one row of lengths per block. Everything is DataFrame functions.

Template: ``<|assistant|>\n``, ``<|user:NAME|>\n`` or ``<|system|>\n``, the text, ``<|end|>\n``. The mark ``<|`` in
names and texts becomes ``< |``.

Results for odd input: a null text is an empty message; a null role is a user without a name and has no
perspective; a null turn comes first; messages of one turn follow a digest of role and text; an equal row
(conversation, turn, role, text) counts once; a null conversation id is an id of its own; a conversation
without participants has no rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NOT_SPEAKERS = ("system",)
TURNS = 64
MOST = 256
_END = "<|end|>"


def _safe(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate(messages: DataFrame, not_speakers=NOT_SPEAKERS, turns: int = TURNS, most: int = MOST) -> DataFrame:
    """(conv_id, perspective, block, start, n_messages, text, mask): mask is an array of (start, end) in ``text``."""
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").distinct()
    tie = F.md5(F.concat_ws("\x1f", F.coalesce("role", F.lit("\x1e")), F.coalesce("text", F.lit("\x1e"))).cast("binary"))
    rows = rows.withColumn("tie", tie).withColumn("run", F.floor(F.col("turn") / turns))
    size = rows.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("n"))
    a, b = rows.alias("a"), size.alias("b")
    rows = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & F.col("a.run").eqNullSafe(F.col("b.run"))).select("a.*", "b.n")
    crowded = F.col("n") > most
    digits = F.ceil(F.log2(F.col("n") / most) / 4).cast("int")
    rows = (rows.withColumn("only", F.when(crowded, F.col("turn")))
            .withColumn("part", F.when(crowded, F.substring("tie", F.lit(1), digits)).otherwise(F.lit(""))))
    speakers = (rows.where(F.col("role").isNotNull() & ~F.col("role").isin(*not_speakers))
                .select("conv_id", F.col("role").alias("perspective")).distinct())
    a, b = rows.alias("a"), speakers.alias("b")
    seen = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))).select("a.*", "b.perspective")
    own = F.col("role").eqNullSafe(F.col("perspective"))
    head = (F.when(own, F.lit("<|assistant|>\n")).when(F.col("role").isin(*not_speakers), F.concat(F.lit("<|"), _safe(F.col("role")), F.lit("|>\n")))
            .otherwise(F.concat(F.lit("<|user:"), _safe(F.col("role")), F.lit("|>\n"))))
    shown = F.concat(head, _safe(F.col("text")), F.lit(_END + "\n"))
    keys = ["conv_id", "perspective", "run", "only", "part"]
    message = F.struct("turn", "tie", shown.alias("shown"), F.length(head).alias("head"), own.alias("own"))
    blocks = (seen.groupBy(*keys).agg(F.sort_array(F.collect_list(message)).alias("m"))
              .withColumn("size", F.transform("m", lambda x: F.length(x["shown"]))))
    before = lambda i: F.aggregate(F.slice("size", F.lit(1), i), F.lit(0), lambda s, x: s + x)
    spans = F.transform("m", lambda x, i: F.when(x["own"], F.struct(
        (before(i) + x["head"]).alias("start"), (before(i + 1) - 1).alias("end"))))
    blocks = blocks.select(*keys, F.size("m").cast("long").alias("n_messages"), F.array_join(F.transform("m", lambda x: x["shown"]), "").alias("text"),
                           F.filter(spans, lambda x: x.isNotNull()).alias("mask"))
    order = Window.partitionBy("conv_id", "perspective").orderBy("run", "only", "part")
    # One narrow row per block goes through the window; texts join it back.
    places = (blocks.select(*keys, F.length("text").cast("long").alias("chars"))
              .select(*keys, (F.row_number().over(order) - 1).cast("long").alias("block"),
                      F.coalesce(F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")))
    a, b = blocks.alias("a"), places.alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return a.join(b, on).select("a.conv_id", "a.perspective", "b.block", "b.start", "a.n_messages", "a.text", "a.mask")
