"""Language identification with language-bitmask n-gram filters.

Training counts the character trigrams of the labelled texts (lower case, runs of other characters than
letters as one blank) per language, over all training rows. A trigram belongs to a language if it makes up
MIN_SHARE or more of that language's trigrams, so a language has at most 1 / MIN_SHARE of them. All
languages share one *bit-sliced Bloom filter*: a table of slots, each a bitmask over languages; a
trigram sets its language's bit in HASHES slots, and the AND of a trigram's slots gives all languages that hold
it in one look. The table has a fixed greatest size and is the only thing broadcast.

A text's trigrams are looked up and the set bits are counted per language. A language whose bit fills a
share f of the slots answers falsely with probability f ** HASHES, and its count c of n is corrected to
(c - n p) / (1 - p). The largest wins; ties go to the language with more training rows, then by name.

Results for odd input: a null text or one without letters is ``und`` with score 0; so is every text if no
row has a language. A text none of whose trigrams is known gets the first language in the order of ties
with score 0. Rows with a null id are not held out and not learned from; repeated rows count each; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import Stages

MIN_SHARE = 1e-5
HASHES = 3
MAX_SLOTS = 1 << 21
SLOTS_PER_GRAM = 12
MAX_LANGUAGES = 512
UNKNOWN = "und"
_GRAMS_HELD = 2_000_000

_letters: list = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def trigrams(text: str | None) -> np.ndarray:
    """The hashed trigrams of a text, repeats included; none if it has no letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    code = np.where(_letter_table()[code], code, 32).astype(np.uint64)
    if not (code != 32).any():
        return np.zeros(0, np.uint64)
    code = np.concatenate([[32], code, [32]]).astype(np.uint64)
    code = code[np.append(True, (code[1:] != 32) | (code[:-1] != 32))]
    h = (code[:-2] << np.uint64(42)) | (code[1:-1] << np.uint64(21)) | code[2:]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def slots(grams: np.ndarray, n_slots: int) -> list[np.ndarray]:
    """HASHES slots of each trigram (double hashing on the two halves of its hash)."""
    a, b = grams & np.uint64(0xFFFFFFFF), (grams >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(k) * b) & np.uint64(n_slots - 1)).astype(np.int64) for k in range(HASHES)]


def _count(batches):
    """(lang, gram, n) of a partition: counted in pieces of bounded size."""
    names = ["lang", "gram", "n"]
    held: dict[str, list] = {}
    size = 0

    def merged(parts):
        grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(at, weights=np.concatenate([c for _, c in parts])).astype(np.int64)

    def flush():
        for lang, parts in held.items():
            g, c = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(c)], names=names)
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            by_lang: dict[str, list] = {}
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(trigrams(text))
            for lang, grams in by_lang.items():
                g, c = np.unique(np.concatenate(grams), return_counts=True)
                held.setdefault(lang, []).append((g, c))
                size += len(g)
        if size > _GRAMS_HELD:
            for lang, parts in held.items():
                held[lang] = [merged(parts)]
            size = sum(len(p[0][0]) for p in held.values())
            if size > _GRAMS_HELD // 2:
                yield from flush()
                size = 0
    yield from flush()


class Model:
    """The languages in the order of ties, the filter (slots x 64-bit words) and each language's false-positive rate."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table
        fill = [((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() if len(table) else 0.0 for i in range(len(languages))]
        self.false = np.array(fill) ** HASHES

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = trigrams(text)
        n = len(grams)
        if not n or not self.languages:
            return UNKNOWN, 0.0
        at = slots(grams, len(self.table))
        found = np.zeros(len(self.languages))
        for w in range(self.table.shape[1]):
            word = self.table[:, w]
            masks, times = np.unique(np.bitwise_and.reduce([word[s] for s in at]), return_counts=True)
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                found[i] = times[(masks >> np.uint64(i % 64)) & np.uint64(1) == 1].sum()
        found = np.clip((found - n * self.false) / np.maximum(1e-9, 1 - self.false), 0, None)
        best = int(found.argmax())
        return self.languages[best], float(min(1.0, found[best] / n))


def fit(rows: DataFrame, stages: Stages, text: str = "text", lang: str = "lang", min_share: float = MIN_SHARE) -> Model:
    """A model of all rows with a language."""
    rows = rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null")
    order = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    languages = [r.lang for r in order]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return Model([], np.zeros((1, 1), np.uint64))
    counts = rows.where("text is not null").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stages.write(counts, "counts")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    least = F.create_map(*[x for k, v in totals.items() for x in (F.lit(k), F.lit(min_share * v))]) if totals else None
    place = F.create_map(*[x for i, k in enumerate(languages) for x in (F.lit(k), F.lit(i))])
    words = -(-len(languages) // 64)
    table = np.zeros((1, words), np.uint64)
    if totals:
        chosen = counts.where(F.col("n") >= least[F.col("lang")]).select("gram", place[F.col("lang")].alias("i"))
        most = max(r["count"] for r in chosen.groupBy("i").count().collect())
        n_slots = min(MAX_SLOTS, 1 << max(6, int(SLOTS_PER_GRAM * most - 1).bit_length()))

        def spread(batches):
            for batch in batches:
                grams, i = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().astype(np.int64)
                bit = np.left_shift(np.uint64(1), (i % 64).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(slots(grams, n_slots))), pa.array(np.tile(i // 64, HASHES)),
                                                  pa.array(np.tile(bit, HASHES))], names=["slot", "word", "mask"])

        # At most MAX_SLOTS rows per 64 languages.
        filled = (chosen.mapInArrow(spread, "slot long, word long, mask long").groupBy("slot", "word")
                  .agg(F.expr("bit_or(mask)").alias("mask")).toArrow())
        table = np.zeros((n_slots, words), np.uint64)
        table[filled.column("slot").to_numpy(), filled.column("word").to_numpy()] = filled.column("mask").to_numpy().view(np.uint64)
    return Model(languages, table)


def predict(rows: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``rows`` with lang_pred and score (replacing columns of those names); only ``text`` is looked at."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in rows.columns if c not in ("lang_pred", "score")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in columns), "lang_pred string", "score double"])

    def run(batches):
        for batch in batches:
            got = [shared.value.predict(t.as_py()) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())], names=[*columns, "lang_pred", "score"])

    return rows.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


def held_out(doc_id) -> F.Column:
    """Every third document by the CRC of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
