"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text). A ledger in the shared folder
remembers which (blob, rule, rule version) has been scanned and what was found. ``update`` scans only
the pairs that the ledger has not seen: one copy of each new blob with all rules, or old blobs with
just the rules whose version is new. ``findings`` joins the ledger's findings back to all paths.

Hot content (one text under a third of all paths) costs one scan: copies meet in a map-side combined
aggregate of digests, and only one row of a blob, chosen by a row number, takes its text along.

Results for odd input: a null text is an empty blob and has no findings; null paths are kept as a path
of their own; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import Stages, keyed

FOUND = "blob binary, rule string, rule_version int, start long, end long"


@dataclass(frozen=True)
class Rule:
    """A pattern; matches whose ``group`` is shorter than ``at_least`` are dropped after matching."""

    name: str
    version: int
    pattern: str
    at_least: int
    group: int = 0
    any_case: bool = False

    @property
    def key(self) -> str:
        return f"{self.name}:{self.version}"


# The base rules, in the order in which ties at one start are listed.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16),
    Rule("hex", 1, r"[0-9a-f]+", 32),
)


def blob_of(text) -> F.Column:
    """The content address of a text (binary, 32 bytes)."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def scan_text(text: str, rules) -> list[tuple[str, int, int, int]]:
    """(rule, version, start, end) of all matches: leftmost, not overlapping within a rule; code points."""
    out = []
    for rule, find in rules:
        for m in find(text):
            a, b = m.span(rule.group)
            if b - a >= rule.at_least:
                out.append((rule.name, rule.version, *m.span()))
    return out


def _compiled(rules):
    def finder(rule):
        # For a run of one character class, asking for the least length at once is the same as
        # dropping short runs later, and much faster.
        p = re.sub(r"^(\[[^\]]+\])\+$", rf"\1{{{rule.at_least},}}", rule.pattern)
        return re.compile(p, re.ASCII | (re.IGNORECASE if rule.any_case else 0)).finditer
    return [(r, finder(r)) for r in rules]


def _scan(rules):
    import pyarrow as pa

    def run(batches):
        by_key = {r.key: (r, f) for r, f in _compiled(rules)}
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for blob, text, todo in zip(*(batch.column(i) for i in range(3))):
                for name, version, a, b in scan_text(text.as_py() or "", [by_key[k] for k in todo.as_py()]):
                    for c, v in zip(cols, (blob.as_py(), name, version, a, b)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                names=["blob", "rule", "rule_version", "start", "end"])

    return run


class Ledger:
    """Findings and scanned pairs as two append-only Parquet tables of one folder."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path
        for table, schema in (("scanned", "blob binary, rule_key string"), ("found", FOUND)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{table}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema("blob binary, rule_key string").parquet(f"{self.path}/scanned")

    def found(self) -> DataFrame:
        # A run that failed between the two appends is repeated by the next: findings count once.
        return self.spark.read.schema(FOUND).parquet(f"{self.path}/found").distinct()


def update(versions: DataFrame, ledger: Ledger, stages: Stages, rules=RULES, path: str = "path", text: str = "text") -> DataFrame:
    """Scan what the ledger has not seen; returns the staged paths (path, blob) of all versions.

    Findings are appended before the scanned pairs, so a run that dies in between loses nothing.
    """
    rows = keyed(versions.select(F.col(path).alias("path"), F.col(text).alias("text")), stages)
    numbered = stages.write(rows.select(F.col("_row.path").alias("path"), blob_of(F.col("_row.text")).alias("blob"), "_n"), "paths")
    all_keys = F.array(*[F.lit(r.key) for r in rules])
    done = ledger.scanned().groupBy("blob").agg(F.collect_set("rule_key").alias("done"))
    todo = (numbered.groupBy("blob").agg(F.min("_n").alias("_n")).join(done, "blob", "left")
            .select("blob", "_n", F.coalesce(F.array_except(all_keys, "done"), all_keys).alias("todo"))
            .where(F.size("todo") > 0))
    todo = stages.write(todo, "todo")
    # One row per unseen blob brings its text, whatever the paths of its copies.
    texts = rows.select("_n", F.col("_row.text").alias("text")).join(todo.hint("merge"), "_n").select("blob", "text", "todo")
    texts.mapInArrow(_scan(rules), FOUND).write.mode("append").parquet(f"{ledger.path}/found")
    todo.select("blob", F.explode("todo").alias("rule_key")).write.mode("append").parquet(f"{ledger.path}/scanned")
    return numbered.select("path", "blob")


def findings(paths: DataFrame, ledger: Ledger, rules=RULES) -> DataFrame:
    """path, blob, spans: for every path the findings of its blob by the given rule versions.

    ``spans`` is an array of (start, place, rule, end), sorted; place is the rule's place in the list.
    """
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    found = ledger.found().withColumn("place", place[F.concat_ws(":", "rule", "rule_version")]).where("place is not null")
    spans = found.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "place", "rule", "end"))).alias("spans"))
    empty = F.array().cast("array<struct<start:bigint,place:int,rule:string,end:bigint>>")
    return paths.join(spans, "blob", "left").select("path", "blob", F.coalesce("spans", empty).alias("spans"))
