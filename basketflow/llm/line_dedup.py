r"""Line dedup with content-defined line chunks.

Every run of two or more worded lines (split at \n; blank lines inside the run belong to it) goes where the same bytes stand
earlier: in a document with a smaller id, or earlier in the document itself without overlapping. Unit of this rule is the pair
of neighbouring worded lines; a pair that overlaps the first occurrence of its bytes stays.

The worded lines of a document are hashed; a chunk ends after a line where the rolling hash over the last three line hashes
is divisible by EVERY, so an inserted or lost line moves the next boundary or two and no more. Chunks of two or more worded lines
are counted by digest, and all but the first of each are taken out whole. Repeats rarely begin and end at boundaries, so they
are then followed line by line: the pairs of neighbouring lines in the chunks that are left, and those across the edges of the
chunks taken out, are counted in the same way. A pair inside a chunk taken out needs no look: it stands in the first
chunk too. The result therefore does not depend on where chunks end; EVERY decides only how much the first step spares the second.

Only digests and places are gathered for all chunks and pairs (combined map-side, so a chunk under a third of all
documents is one small row per task). The first occurrence of each repeated digest is fetched, and every
other is removed only where its bytes equal those. (Of two different chunks with one MD5 the later one would stay, its inner
pairs unseen.) The documents are shuffled by row, never by chunk, and joins by digest have one row per digest on one side.

``passages`` finds the same runs without chunks: all pairs are counted at once.

Everything is DataFrame functions. Results for odd input: a null text stays null, an empty one empty; a null
id counts as larger than any other; rows that agree in id and text are one document and stay alike; rows
with one id and different texts are ordered by a digest; an empty table gives an empty result; all
columns but the text pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import Stages, text_digest

EVERY = 4  # expected worded lines in a chunk
_LAST = 2 ** 63 - 1
_BLANKS = " \t\n\x0b\f\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _part(lines: Column, start: Column, end: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, end - start), "\n")


def _units(rows: DataFrame) -> DataFrame:
    """rows with l (lines), w (places of worded lines) and p (start, end and digest of each pair of neighbours in w)."""
    df = rows.select("ord", "dk", _lines(F.col("text")).alias("l"))
    df = df.withColumn("w", F.filter(F.transform("l", lambda x, i: F.when(F.length(F.translate(x, _BLANKS, "")) > 0, i)), lambda i: i.isNotNull()))
    df = df.where(F.size("w") > 1)
    # The digests are taken before an explode, which then copies no lines.
    return df.withColumn("p", F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), lambda a, j: _unit(a, F.get("w", j + 1) + 1)))


def _unit(start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"), F.unhex(F.md5(_part(F.col("l"), start, end).cast("binary"))).alias("digest"))


def chunks(rows: DataFrame, every: int = EVERY) -> DataFrame:
    """(ord, dk, c, pairs) of all chunks of rows (ord, dk, text).

    c is (start, end, digest), lines from 0; the digest of a chunk of one worded line is null. pairs are the pairs that begin in
    the chunk, the last of them across its end.
    """
    df = _units(rows).withColumn("v", F.transform("w", lambda i: F.conv(F.substring(F.md5(F.get("l", i).cast("binary")), 1, 7), 16, 10).cast("long")))
    back = lambda i, k: F.when(i >= k, F.get("v", F.greatest(i - k, F.lit(0)))).otherwise(F.lit(0))
    roll = lambda x, i: x + 31 * back(i, 1) + 961 * back(i, 2)
    ends = F.filter(F.transform("v", lambda x, i: F.when(roll(x, i) % every == 0, i + 1)), lambda x: x.isNotNull())
    df = df.withColumn("ends", F.array_union(ends, F.array(F.size("w"))))

    def chunk(b: Column, j: Column) -> Column:
        a = F.when(j > 0, F.get("ends", F.greatest(j - 1, F.lit(0)))).otherwise(F.lit(0))
        unit = _unit(F.get("w", a), F.get("w", b - 1) + 1)
        return F.struct(unit.withField("digest", F.when(b - a > 1, unit["digest"])).alias("c"), F.slice("p", a + 1, b - a).alias("pairs"))

    return df.select("ord", "dk", F.explode(F.transform("ends", chunk)).alias("x")).select("ord", "dk", "x.*")


def pairs(rows: DataFrame) -> DataFrame:
    """(ord, dk, start, end, digest) of all pairs of neighbouring worded lines of rows (ord, dk, text)."""
    return _units(rows).select("ord", "dk", F.explode("p").alias("p")).select("ord", "dk", "p.*")


def _firsts(units: DataFrame) -> DataFrame:
    """(digest, first) of the digests that stand more than once."""
    return (units.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "dk", "start", "end")).alias("first"))
            .where("n > 1").select("digest", "first"))


_LATER = "(struct(ord, dk) <> struct(first.ord, first.dk) or start >= first.end)"
_PLACE = ["digest", "ord", "dk", "start", "end"]


def dedup(docs: DataFrame, stages: Stages, every: int = EVERY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the repeated runs of lines cut from ``text``, n_lines and n_removed (lines).

    The two counts replace columns of those names. A document whose lines all go keeps an empty text.
    """
    def find(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = stages.write(chunks(rows, every), "chunks")
        several = found.where("c.digest is not null").select("ord", "dk", "c.*", "pairs")
        firsts = stages.write(_firsts(several), "firsts")
        copies = several.join(firsts, "digest").where(_LATER).select(*_PLACE)
        gone = F.coalesce(F.col("first").isNotNull() & F.expr(_LATER), F.lit(False))
        left = F.when(gone, F.filter("pairs", lambda p: p["end"] > F.col("end"))).otherwise(F.col("pairs"))
        left = several.join(firsts, "digest", "left").select("ord", "dk", left.alias("pairs"))
        left = left.unionByName(found.where("c.digest is null").select("ord", "dk", "pairs"))
        edges = stages.write(left.select("ord", "dk", F.explode("pairs").alias("p")).select("ord", "dk", "p.*"), "edges")
        more = stages.write(_firsts(edges), "edge-firsts")
        later = copies.unionByName(edges.join(more, "digest").where(_LATER).select(*_PLACE))
        later = stages.write(later, "later")
        stages.drop("chunks", "edges")
        return later, firsts.unionByName(more)

    return _cut(docs, stages, find, text, doc_id)


def passages(docs: DataFrame, stages: Stages, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Like ``dedup``, all pairs of neighbouring worded lines counted at once."""
    def find(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = stages.write(pairs(rows), "chunks")
        firsts = stages.write(_firsts(found), "firsts")
        return found.join(firsts, "digest").where(_LATER).select(*_PLACE), firsts

    return _cut(docs, stages, find, text, doc_id)


def _cut(docs: DataFrame, stages: Stages, find, text: str, doc_id: str) -> DataFrame:
    columns = [c for c in docs.columns if c not in (text, "n_lines", "n_removed")]
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("ord"), text_digest(F.col(text)).alias("dk"),
                       F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("rest") if columns else F.lit(None).alias("rest"))
    later, firsts = find(rows.where("text is not null"))
    wanted = (firsts.select("digest", "first.*").groupBy("ord", "dk").agg(F.collect_list(F.struct("digest", "start", "end")).alias("wanted")))
    # The condition on "rest" always holds. It makes this side ask for the same columns as the join at the
    # end, so that both read one shuffle of the documents (the planner reuses equal exchanges).
    r, w = rows.alias("r"), wanted.alias("w")
    texts = (r.join(w, (F.col("r.ord") == F.col("w.ord")) & (F.col("r.dk") == F.col("w.dk")) & (F.pmod(F.xxhash64("rest", "wanted"), F.lit(1)) == 0))
             .select("text", "wanted").select(_lines(F.col("text")).alias("l"), F.explode("wanted").alias("w"))
             .select("w.digest", _part(F.col("l"), F.col("w.start"), F.col("w.end")).alias("bytes")).dropDuplicates(["digest"]))
    marks = (later.join(texts, "digest").groupBy("ord", "dk").agg(F.sort_array(F.collect_set(F.struct("start", "end", "bytes"))).alias("marks")))
    marked = rows.join(marks, ["ord", "dk"], "left").withColumn("l", _lines(F.col("text")))
    same = F.filter("marks", lambda m: _part(F.col("l"), m["start"], m["end"]) == m["bytes"])
    # Units overlap, so lines are cut by number.
    gone = F.array_distinct(F.flatten(F.transform(same, lambda m: F.sequence(m["start"], m["end"] - 1))))
    marked = marked.withColumn("gone", F.coalesce(gone, F.array().cast("array<int>")))
    n, size = F.size("gone"), F.size("l")
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), size - 1), F.col("gone")), lambda i: F.get("l", i)), "\n")
    out = marked.withColumn("kept", F.when(n == 0, F.col("text")).otherwise(kept))
    order = [F.col("kept").alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(size)
    return out.select(*order, lines.cast("long").alias("n_lines"), n.cast("long").alias("n_removed"))
