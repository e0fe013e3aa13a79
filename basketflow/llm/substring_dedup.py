"""Substring dedup with prefix-partitioned sparse suffix trees.

A window is ``MIN_WORDS`` consecutive words of one document; every word covered by a window whose word
sequence also starts in a document with a smaller id goes. Windows are judged on the input.

1. *Sampled suffixes.* Each document's suffixes are sampled at the minimizers of its PREFIX-word grams:
   every window contains a sampled position, chosen by the window's words alone, so two equal windows
   hold the same sample at the same offset. About one suffix in twenty is kept.
2. *Pruning by prefix.* Suffixes are counted by the hash of their first PREFIX words (combined
   map-side). A prefix seen in one document only has no deep node and is dropped.
   Later copies of a whole document lose all words and take no further part.
3. *Contexts.* What decides about a sampled suffix are the words up to a window's length to both sides.
   Occurrences with the same context are one leaf with its smallest id.
   A prefix with one leaf needs no tree: later documents lose its windows, the first keeps them.
4. *Subtrees.* The leaves of the other prefixes are dealt out by prefix and built in memory-sized
   batches: leaves sorted by the words to the right, with the LCP of neighbours (the suffix tree as leaf
   order and depths), and the same for the words to the left. A node of depth d is a run of leaves with
   LCP >= d; leaves that share a node of depth MIN_WORDS - o to the right and one of depth o to the left
   repeat a window that starts o words before the sample.
5. *Longer prefixes.* A prefix with more than MAX_LEAVES leaves does not fit in one task. Its suffixes
   get the longest useful prefix, all MIN_WORDS words, where a subtree is a single deep node, and its
   smallest id is a plain aggregate.

Results for odd input: a null or empty text has no words; a null id counts as larger than any other; rows
with one id never remove each other's words, whether equal or not; repeated rows give repeated results;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import Stages, text_digest

MIN_WORDS = 50
PREFIX = 12
MAX_LEAVES = 20_000
BATCH_LEAVES = 20_000
MASK_BITS = 64  # of the offsets in a context at which a window may start
_LAST = 2 ** 63 - 1  # stands for a null id
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Mixed polynomial hashes of all runs of k words, by doubling."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, block, size = None, 0, hashes, 1
    power = lambda e: np.uint64(pow(int(_BASE), e, 1 << 64))
    while True:
        if k & size:
            part = block[done:done + n]
            out = part if out is None else out * power(size) + part
            done += size
        if size * 2 > k:
            break
        block = block[:-size] * power(size) + block[size:]
        size *= 2
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def _slide(a: np.ndarray, w: int, best) -> np.ndarray:
    """best over all runs of w values, by doubling."""
    size, cur = 1, a
    while size * 2 <= w:
        cur = best(cur[:-size], cur[size:])
        size *= 2
    return best(cur[:len(a) - w + 1], cur[w - size:w - size + len(a) - w + 1])


def _word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _samples(words: list[bytes], window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions and the hashes of their prefixes; ties are all sampled."""
    if len(words) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = _grams(_word_hashes(words), k)
    w = window - k + 1
    lows = _slide(grams, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)
    seen = _slide(np.concatenate([edge, lows, edge]), w, np.maximum)
    at = np.flatnonzero(grams == seen)
    return at, grams[at]


def _sha(words) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def _batch(cols, types):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.values())], names=list(types))


def _sample_rows(window: int, k: int):
    types = {"h": pa.int64(), "ord": pa.int64(), "dk": pa.int64(), "pos": pa.int32(), "sha": pa.binary()}

    def run(batches):
        for batch in batches:
            hs, counts, poss, shas, ns = [], [], [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or b"").split()
                at, h = _samples(words, window, k)
                hs += [np.array([len(words)], np.int64), h.view(np.int64)]
                poss += [np.array([-1], np.int32), at.astype(np.int32)]
                counts.append(1 + len(at))
                shas.append(_sha(words))
            if not counts:
                continue
            rep = np.repeat(np.arange(len(counts)), counts)
            sha: list = [None] * len(rep)
            for i, s in zip(np.cumsum([0] + counts[:-1]).tolist(), shas):
                sha[i] = s
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hs)), batch.column("ord").take(pa.array(rep)), batch.column("dk").take(pa.array(rep)),
                 pa.array(np.concatenate(poss)), pa.array(sha, pa.binary())], names=list(types))

    return run


def _contexts(window: int, k: int, with_text: bool):
    """(h, ctx, ord, dk, pos[, left, words]) of the listed positions; ctx is a digest of the context."""
    import xxhash
    types = {"h": pa.int64(), "ctx": pa.int64(), "ord": pa.int64(), "dk": pa.int64(), "pos": pa.int32()}
    if with_text:
        types |= {"left": pa.int32(), "words": pa.binary()}

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                cols: list[list] = [[] for _ in types]
                part = whole.slice(start, 128)
                for text, o, d, at in zip(*(part.column(c) for c in ("text", "ord", "dk", "positions"))):
                    words, at = text.as_py().split(), at.as_py()
                    grams = _grams(_word_hashes(words), k).view(np.int64)[at].tolist()
                    o, d = o.as_py(), d.as_py()
                    for p, h in zip(at, grams):
                        left = min(p, window - k)
                        ctx = b" ".join(words[p - left:p + window])
                        row = (h, xxhash.xxh3_64_intdigest(ctx, left) - 2 ** 63, o, d, p, left, ctx)
                        for c, v in zip(cols, row):
                            c.append(v)
                yield _batch(cols, types)

    return run


def _leaf_classes(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """For every leaf the node of the given depth above it (as a number)."""
    out = np.empty(len(order), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(lcp < depth)])
    return out


def _sorted_leaves(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort(m.T[::-1])
    differ = m[order[1:]] != m[order[:-1]]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), m.shape[1])
    return order, lcp


def repeated_windows(contexts: list[bytes], left: np.ndarray, first: np.ndarray, window: int, k: int) -> np.ndarray:
    """For every leaf the windows that a leaf with a smaller ``first`` has too.

    Bit o of the result: the window that starts o words before the sample.
    """
    n, reach = len(contexts), window - k
    ids: dict[bytes, int] = {}
    numbers, size = array("i"), np.zeros(n, np.int64)
    for i, c in enumerate(contexts):
        words = c.split()
        size[i] = len(words)
        numbers.extend([ids.setdefault(w, len(ids)) for w in words])
    flat = np.frombuffer(numbers, np.int32)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    own = -1 - np.arange(n, dtype=np.int32)[:, None]  # past the end of a document: equal to nothing

    def side(offsets, length):
        at = (begin + left)[:, None] + offsets
        ok = np.arange(len(offsets)) < length[:, None]
        return np.where(ok, flat[np.where(ok, at, 0)], own)

    right_order, right_lcp = _sorted_leaves(side(np.arange(window), size - left))
    left_order, left_lcp = _sorted_leaves(side(-1 - np.arange(reach), left)) if reach else (np.arange(n), np.zeros(n - 1, int))
    masks = np.zeros(n, np.int64)
    for o in range(reach + 1):
        node = _leaf_classes(right_order, right_lcp, window - o)
        node = node * n + (_leaf_classes(left_order, left_lcp, o) if o else 0)
        by = np.lexsort((first, node))
        starts = np.flatnonzero(np.concatenate([[True], np.diff(node[by]) != 0]))
        lowest = np.repeat(first[by][starts], np.diff(np.append(starts, n)))
        masks[by] |= (first[by] > lowest).astype(np.int64) << o
    return masks


def _subtrees(window: int, k: int, batch_leaves: int):
    """Over rows sorted by h: builds whole subtrees in batches; returns (h, ctx, mask)."""
    types = {"h": pa.int64(), "ctx": pa.int64(), "mask": pa.int64()}

    def build(parts):
        t = pa.Table.from_batches(parts)
        masks = repeated_windows(t.column("words").to_pylist(), t.column("left").to_numpy(), t.column("ord").to_numpy(), window, k)
        hit = np.flatnonzero(masks)
        got = t.select(["h", "ctx"]).take(pa.array(hit)).combine_chunks()
        yield from got.append_column("mask", pa.array(masks[hit])).cast(pa.schema(list(types.items()))).to_batches()

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            hs = batch.column("h").to_numpy()
            if rows >= batch_leaves:
                # Cut at the first new prefix of this batch, so that no subtree is split.
                last = held[-1].column("h")[-1].as_py()
                new = np.flatnonzero(hs != last)
                cut = int(new[0]) if len(new) else batch.num_rows
                held.append(batch.slice(0, cut))
                if len(new):
                    yield from build(held)
                    held, rows, batch = [], 0, batch.slice(cut)
                else:
                    continue
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield from build(held)

    return run


def _whole_prefixes(window: int):
    """All windows of a context, each under its whole word sequence: (key, h, ctx, o, ord)."""
    import xxhash
    types = {"key": pa.binary(), "h": pa.int64(), "ctx": pa.int64(), "o": pa.int32(), "ord": pa.int64()}

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in types]
            for h, ctx, o, left, words in zip(*(batch.column(c).to_pylist() for c in ("h", "ctx", "ord", "left", "words"))):
                ws = words.split()
                for s in range(len(ws) - window + 1):
                    if s > left:
                        break
                    for c, v in zip(cols, (xxhash.xxh3_128_digest(b" ".join(ws[s:s + window])), h, ctx, left - s, o)):
                        c.append(v)
            yield _batch(cols, types)

    return run


def _spans(n: int, removed, window: int, k: int) -> np.ndarray:
    """Which of n words go; ``removed`` has (position, mask), mask -1 for every window of the context."""
    edge = np.zeros(n + 1, np.int64)
    for p, mask in removed:
        for o in range(max(0, window - (n - p)), min(p, window - k) + 1):
            if mask >> o & 1:
                edge[p - o] += 1
                edge[p - o + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def _cut(window: int, k: int):
    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for o, d, text, removed in zip(*(batch.column(c) for c in ("ord", "dk", "text", "removed"))):
                words = text.as_py().split()
                gone = _spans(len(words), [(r["pos"], r["mask"]) for r in removed.as_py()], window, k)
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
                for c, v in zip(out, (o.as_py(), d.as_py(), int(gone.sum()), _sha(kept),
                                      [{"start": int(a), "end": int(b)} for a, b in turn.reshape(-1, 2)], b" ".join(kept))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary()),
                 pa.array(out[4], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(out[5], pa.binary())],
                names=["ord", "dk", "n_removed", "sha", "spans", "kept"])

    return run


_CUT = "ord long, dk long, n_removed long, sha binary, spans array<struct<start:long,end:long>>, kept binary"


def dedup(docs: DataFrame, stages: Stages, window: int = MIN_WORDS, prefix: int = PREFIX, max_leaves: int = MAX_LEAVES,
          batch_leaves: int = BATCH_LEAVES, text: str = "text", doc_id: str = "doc_id", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (hex) and spans (removed word ranges) of every row.

    ``with_text`` adds ``kept``: the kept words joined by one space (null where nothing was removed).
    """
    if not 0 <= window - prefix < MASK_BITS:
        raise ValueError(f"a window has from prefix to prefix + {MASK_BITS - 1} words, not {window} with a prefix of {prefix}")
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("ord"), text_digest(F.col(text)).alias("dk"),
                       F.col(text).cast("binary").alias("text"))
    sampled = stages.write(rows.mapInArrow(_sample_rows(window, prefix), "h long, ord long, dk long, pos int, sha binary"), "samples")
    every = sampled.where("pos < 0").select("ord", "dk", F.col("h").alias("n_words"), F.col("sha").alias("whole"))
    # All words of a later copy go, and a copy is never the first to have a window: copies need no tree.
    whole = every.where(F.col("n_words") >= window)
    copies = whole.join(whole.groupBy("whole").agg(F.min("ord").alias("lowest")), "whole").where("ord > lowest").select("ord", "dk")
    copies = stages.write(copies, "copies")
    suffixes = sampled.where("pos >= 0").select("h", "ord", "dk", "pos")
    shared = suffixes.groupBy("h").agg(F.min("dk").alias("a"), F.max("dk").alias("b")).where("a < b").select("h")
    listed = (suffixes.join(shared, "h", "left_semi").groupBy("ord", "dk")
              .agg(F.sort_array(F.collect_set("pos")).alias("positions")).join(copies, ["ord", "dk"], "left_anti"))
    # Only documents with a shared prefix take their text along from here.
    hit_docs = stages.write(rows.dropna(subset=["text"]).join(listed, ["ord", "dk"]), "hit_docs")

    contexts = stages.write(hit_docs.mapInArrow(_contexts(window, prefix, False), "h long, ctx long, ord long, dk long, pos int"), "contexts")
    leaves = stages.write(contexts.groupBy("h", "ctx").agg(F.min(F.struct("ord", "dk", "pos")).alias("one")).select("h", "ctx", "one.*"), "leaves")
    per_prefix = leaves.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    branching = leaves.join(per_prefix, "h")

    def with_words(some):
        wanted = some.groupBy("ord", "dk").agg(F.collect_list("pos").alias("positions"))
        return (hit_docs.select("ord", "dk", "text").join(wanted, ["ord", "dk"])
                .mapInArrow(_contexts(window, prefix, True), "h long, ctx long, ord long, dk long, pos int, left int, words binary")
                .select("h", "ctx", "ord", "left", "words"))

    masks = (with_words(branching.where(F.col("n") <= max_leaves)).repartition("h").sortWithinPartitions("h")
             .mapInArrow(_subtrees(window, prefix, batch_leaves), "h long, ctx long, mask long"))
    if per_prefix.where(F.col("n") > max_leaves).limit(1).collect():
        windows = stages.write(with_words(branching.where(F.col("n") > max_leaves))
                               .mapInArrow(_whole_prefixes(window), "key binary, h long, ctx long, o int, ord long"), "windows")
        lowest = windows.groupBy("key").agg(F.min("ord").alias("lowest"))
        later = windows.join(lowest, "key").where("ord > lowest")
        masks = masks.unionByName(later.groupBy("h", "ctx").agg(F.expr("bit_or(shiftleft(1L, o))").alias("mask")))

    judged = leaves.select("h", "ctx", F.col("ord").alias("lowest")).join(masks.groupBy("h", "ctx").agg(F.max("mask").alias("mask")), ["h", "ctx"], "left")
    removed = (contexts.join(judged, ["h", "ctx"])
               .select("ord", "dk", "pos", F.when(F.col("ord") > F.col("lowest"), F.lit(-1)).otherwise(F.col("mask")).cast("long").alias("mask"))
               .where("mask is not null").groupBy("ord", "dk").agg(F.collect_set(F.struct("pos", "mask")).alias("removed")))
    cut = hit_docs.select("ord", "dk", "text").join(removed, ["ord", "dk"]).mapInArrow(_cut(window, prefix), _CUT)
    cut = (cut if with_text else cut.drop("kept")).dropDuplicates(["ord", "dk"])
    no_spans = F.array().cast("array<struct<start:long,end:long>>")
    whole_span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    copy = F.col("copy").isNotNull()
    return (every.join(cut, ["ord", "dk"], "left").join(copies.distinct().withColumn("copy", F.lit(True)), ["ord", "dk"], "left").select(
        F.when(F.col("ord") < _LAST, F.col("ord")).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.lower(F.hex(F.when(copy, F.lit(_sha([]))).otherwise(F.coalesce("sha", "whole")))).alias("kept_sha256"),
        F.when(copy, whole_span).otherwise(F.coalesce("spans", no_spans)).alias("spans"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept").cast("string")).alias("kept")] if with_text else [])))
