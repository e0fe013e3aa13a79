r"""License scans by diagonal voting.

Words are the runs of ASCII letters (A-Z as a-z), digits and characters beyond ASCII. Templates are short phrases
and the standing sentences of public licenses; each has words, a label, the number of its words that a span must show
(``need``) and how far a span may shift (``slack``).

*Votes.* Every rolling word k-gram of every text is hashed and joined to the hashes of the templates' k-grams (K words,
or all words of a shorter template). A match at word p of the text and word q of the template is a vote for the
diagonal p - q. The gram itself travels beside its hash, and a vote counts only where both grams are equal.

*Diagonals.* Votes are counted by (row, template, diagonal). A lost or added word moves the rest of a span to a
neighbouring diagonal, so each diagonal also collects the votes of those up to ``slack`` beside it. A span is verified
where these votes cover at least ``need`` different words of the template; of neighbouring spans of one template the
one with most words stays (then most votes of its own diagonal, then the smallest). The base phrases have no slack and
need all their words, so each place where their words stand consecutively is one span.

Everything is DataFrame functions. A long text is cut into blocks of words before its grams are made, and a vote is one
small row; only votes are shuffled, by (row, template, diagonal), so neither a frequent gram nor a frequent template
gathers rows. What meets in one task is what one row's text holds. The grams of the templates are broadcast: at most
MAX_TEMPLATE_WORDS, whatever the corpus.

Results for odd input: a null or empty text has no words, no span and score 0; a null id is an id; repeated rows each
have their result; an empty table gives an empty result; other columns pass through ``scan`` under their names.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.llm.common import Stages, keyed

K = 3
SLACK = 3
SHORT = 8  # a template of so many words must show all of them
SHARE = 0.8  # of the words of a longer one
BLOCK = 4_096  # words whose grams are made at once
MAX_TEMPLATE_WORDS = 100_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Standing sentences of public licenses.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0"),
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl-notice"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("cc by nc 4 0", "cc-by-nc-4.0"),
    ("cc by sa 4 0", "cc-by-sa-4.0"),
    ("cc by 4 0", "cc-by-4.0"),
    ("creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa-4.0"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc-4.0"),
    ("the software is provided as is without warranty of any kind express or implied", "no-warranty"),
)


class Template(NamedTuple):
    words: tuple[str, ...]
    label: str
    base: bool
    need: int
    slack: int
    gram: int


def templates(notices=NOTICES, base=BASE, k: int = K, slack: int = SLACK, short: int = SHORT, share: float = SHARE) -> list[Template]:
    out = []
    for texts, is_base in ((base, True), (notices, False)):
        for text, label in texts:
            w = tuple(text.split())
            need = len(w) if is_base or len(w) <= short else -int(-share * len(w) // 1)
            out.append(Template(w, label, is_base, need, 0 if is_base else slack, min(k, len(w))))
    if sum(len(t.words) for t in out) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words in all")
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z as a-z and nothing else; ``lower`` does that where all characters are ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def license_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _template_grams(spark: SparkSession, found: list[Template]) -> DataFrame:
    """(h, tgram, tid, tpos) of every gram of every template; a constant of the plan."""
    grams = [{"tid": tid, "tpos": p, "tgram": " ".join(t.words[p:p + t.gram])}
             for tid, t in enumerate(found) for p in range(len(t.words) - t.gram + 1)]
    rows = F.from_json(F.lit(json.dumps(grams)), "array<struct<tid:int,tpos:int,tgram:string>>")
    return spark.range(1).select(F.inline(rows)).withColumn("h", F.xxhash64("tgram"))


def _grams(rows: DataFrame, lengths: list[int], block: int) -> DataFrame:
    """(row, pos, gram) of every rolling gram of rows (row, text)."""
    longest = max(lengths)
    w = rows.select("row", license_words(F.col("text")).alias("w")).where(F.size("w") >= min(lengths))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / block).cast("int")), lambda b: F.struct(
        (b * block).alias("at"), F.slice("w", b * block + 1, F.lit(block + longest - 1)).alias("w")))
    blocks = w.select("row", F.explode(cut).alias("b")).select("row", "b.at", "b.w")

    def of_length(n: int) -> Column:
        def gram(x, i):
            return F.struct((F.col("at") + i).alias("pos"), F.concat_ws(" ", x, *[F.get("w", i + j) for j in range(1, n)]).alias("gram"))
        return F.transform(F.slice("w", F.lit(1), F.greatest(F.lit(0), F.least(F.lit(block), F.size("w") - n + 1))), gram)

    each = [of_length(n) for n in lengths]
    return blocks.select("row", F.explode(F.concat(*each)).alias("g")).select("row", "g.pos", "g.gram")


def spans(rows: DataFrame, found: list[Template], block: int = BLOCK) -> DataFrame:
    """(row, tid, start, end, covered): the verified spans of rows (row, text); words from 0, end exclusive."""
    spark = rows.sparkSession
    of = lambda field: F.get(F.from_json(F.lit(json.dumps([getattr(t, field) for t in found])), "array<int>"), F.col("tid"))
    grams = _grams(rows, sorted({t.gram for t in found}), block).withColumn("h", F.xxhash64("gram"))
    # The templates' grams are bounded by MAX_TEMPLATE_WORDS, so their broadcast is too.
    hits = grams.join(F.broadcast(_template_grams(spark, found)), "h").where("gram = tgram")
    votes = hits.select("row", "tid", "tpos", "pos", of("slack").alias("slack"), of("gram").alias("n"))
    # Each vote counts for its own diagonal and those beside it; a diagonal has one vote per template word at most.
    votes = votes.select("row", "tid", "tpos", "pos", "n", F.explode(F.sequence(-F.col("slack"), F.col("slack"))).alias("shift"))
    merged = votes.groupBy("row", "tid", (F.col("pos") - F.col("tpos") + F.col("shift")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("seen"), F.count_if(F.col("shift") == 0).alias("own"), F.min("pos").alias("start"),
        F.max(F.col("pos") + F.col("n")).alias("end"), F.first("n").alias("n"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("seen", lambda t: F.sequence(t, t + F.col("n") - 1)))))
    good = merged.withColumn("covered", covered).where((F.col("own") > 0) & (F.col("covered") >= of("need")))
    widest = 2 * max(t.slack for t in found)
    near = Window.partitionBy("row", "tid").orderBy("diagonal").rangeBetween(-widest, widest)
    rank = F.struct("covered", "own", -F.col("diagonal"))
    best = good.withColumn("best", F.max(rank).over(near)).where((of("slack") == 0) | (F.col("best") == rank))
    return best.select("row", "tid", "start", "end", "covered")


def scan(docs: DataFrame, stages: Stages, found: list[Template] | None = None, text: str = "text", block: int = BLOCK) -> DataFrame:
    """(_row, n_words, spans): the row as given, its number of words, and its spans in order of start and label.

    A span has start, end (words, end exclusive), label, base, covered and words (of the template).
    """
    found = templates() if found is None else found
    rows = keyed(docs, stages)
    texts = rows.select(F.col("_n").alias("row"), F.col(f"_row.`{text}`").alias("text"))
    info = F.get(F.from_json(F.lit(json.dumps([{"label": t.label, "base": t.base, "words": len(t.words)} for t in found])),
                             "array<struct<label:string,base:boolean,words:int>>"), F.col("tid"))
    one = F.struct("start", "end", info["label"].alias("label"), info["base"].alias("base"), "covered", info["words"].alias("words"))
    # The spans of one row, at most some per word of its text.
    by_row = spans(texts, found, block).groupBy("row").agg(F.sort_array(F.collect_list(one)).alias("spans"))
    sized = rows.select("_n", "_row", F.size(license_words(F.col(f"_row.`{text}`"))).cast("long").alias("n_words"))
    joined = sized.join(by_row, F.col("_n") == F.col("row"), "left")
    none = F.array().cast("array<struct<start:int,end:int,label:string,base:boolean,covered:int,words:int>>")
    return joined.select("_row", "n_words", F.coalesce("spans", none).alias("spans"))
