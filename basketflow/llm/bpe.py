"""Byte-level BPE encoding and decoding over a public rank file.

Encoding splits a text by a pattern and merges the bytes of each piece: always the adjacent pair of
lowest rank, leftmost first. The pairs wait in a *hierarchical-bitmap rank queue*: one bucket of
linked-list positions per rank, and a two-level bitmap (256 ranks to a word) over the ranks whose
bucket is not empty. Find-first-set on two words gives the next rank whatever the length of the
piece; entries whose pair has changed since they were queued are skipped when they come up. A piece
of n bytes costs O(n log n) at worst (the log is the order of positions inside one bucket), so a
piece of a million bytes without white space is no problem.

Pieces repeat a lot, so a worker keeps the ids of the pieces it saw last, in two generations of
bounded size: dropping an old generation only costs time, never changes a result.

Results for odd input: a null or empty text has no ids and decodes to no bytes; rows are kept as they
are, repeated rows give repeated results; other columns pass through unchanged.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as the rank files' library counts it (the Unicode property); Python also counts
# the four separators U+001C to U+001F.
_WHITE = r"\t-\r \x85\xa0  -     　"

# Rank files and patterns are read on the driver and broadcast: refuse anything beyond this size.
MAX_VOCAB_BYTES = 64 << 20
CACHE_PIECES = 500_000  # about 80 MB in a worker; an executor has one per core
CACHE_PIECE_BYTES = 64
_SHIFT = 20  # bits for a rank in a pair's key


def read_vocab(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks, from lines of base64 and a number."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCAB_BYTES + 1)
    if len(data) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCAB_BYTES} bytes")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def compile_pattern(pattern: str):
    """The splitting pattern with white space spelled out."""
    import regex
    return regex.compile(pattern.replace(r"[^\s", "[^" + _WHITE).replace(r"\S", f"[^{_WHITE}]")
                         .replace(r"\s", f"[{_WHITE}]"))


class Encoder(dict):
    """Encodes texts; as a mapping, a piece and its ids as little-endian 32-bit numbers.

    The rank queue is ``buckets`` (rank to a heap of positions) under a two-level bitmap: ``low`` has a
    256-bit word for each run of 256 ranks, ``top`` a bit for each word that is not zero. The queue is empty
    between pieces, so its words are allocated once.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        if len(ranks) > 1 << _SHIFT:
            raise ValueError(f"more than {1 << _SHIFT} ranks")
        self.ranks = ranks
        self.bytes = [ranks.get(bytes([b])) for b in range(256)]
        #: The rank of what two tokens give, for all splits of all tokens.
        self.pairs = {(x << _SHIFT) | y: r for token, r in ranks.items() for i in range(1, len(token))
                      if (x := ranks.get(token[:i])) is not None and (y := ranks.get(token[i:])) is not None}
        self.low = [0] * ((max(ranks.values(), default=0) >> 8) + 1)
        self.buckets: dict[int, list[int]] = {}
        self.find = compile_pattern(pattern).findall
        self.old: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece. The queue is written out in place: this is the inner loop."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        get, low, buckets, n = self.pairs.get, self.low, self.buckets, len(piece)
        token: list = [self.bytes[b] for b in piece]
        token.append(-1)  # the end; no pair has it
        top, after, before = 0, list(range(1, n + 2)), list(range(-1, n))
        pair: list = []  # rank of the pair that starts at a live position
        for i in range(n - 1):
            r = get((token[i] << _SHIFT) | token[i + 1])
            pair.append(r)
            if r is not None:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    low[r >> 8] |= 1 << (r & 255)
                    top |= 1 << (r >> 8)
        pair += [None, None]
        while top:
            t = (top & -top).bit_length() - 1
            word = low[t]
            first = word & -word
            r = (t << 8) + first.bit_length() - 1
            bucket = buckets[r]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[r]
                low[t] = word = word ^ first
                if not word:
                    top ^= 1 << t
            if pair[i] != r:
                continue  # stale: the pair at i has changed, or i has been merged away
            j = after[i]
            end = after[j]
            after[i], before[end], pair[j], token[i] = end, i, None, r
            start = before[i] if i else i
            while True:  # the pairs to the left and to the right of the merged token
                pair[start] = r = get((token[start] << _SHIFT) | token[after[start]])
                if r is not None:
                    if r in buckets:
                        heappush(buckets[r], start)
                    else:
                        buckets[r] = [start]
                        low[r >> 8] |= 1 << (r & 255)
                        top |= 1 << (r >> 8)
                if start == i:
                    break
                start = i
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = after[i]
        return out

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(self.merge(piece.encode("utf-8")), "<i4").tobytes()
        if len(ids) <= 4 * CACHE_PIECE_BYTES and len(piece) <= CACHE_PIECE_BYTES:
            if len(self) >= CACHE_PIECES // 2:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text))) if text else b""


_encoders: dict[tuple, Encoder] = {}


def _encoder(key: str, vocab, pattern: str) -> Encoder:
    """This worker's encoder; kept between tasks, for its cache."""
    if (key, pattern) not in _encoders:
        _encoders.clear()
        _encoders[key, pattern] = Encoder(vocab.value, pattern)
    return _encoders[key, pattern]


def _slices(batches, rows: int = 256):
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a column ``ids`` (array of int) of the token ids of ``text``."""
    spark: SparkSession = df.sparkSession
    vocab, key = spark.sparkContext.broadcast(ranks), str(hash(frozenset(ranks.items())))
    schema = T.StructType([f for f in df.schema.fields if f.name != ids] + [T.StructField(ids, T.ArrayType(T.IntegerType()))])
    names = [f.name for f in schema.fields[:-1]]

    def run(batches):
        enc = _encoder(key, vocab, pattern)
        for batch in _slices(batches):
            got = [enc.encode(t) for t in batch.column(text).to_pylist()]
            ends = np.cumsum([0] + [len(x) // 4 for x in got], dtype="int64")
            if ends[-1] >= 2 ** 31:
                raise ValueError("a batch of texts has over 2^31 tokens")
            values = pa.array(np.frombuffer(b"".join(got), "<i4"), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends.astype("int32")), values)
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [lists], names=names + [ids])

    return df.select(*[F.col(f"`{n}`") for n in dict.fromkeys([*names, text])]).mapInArrow(run, schema)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with a column ``out`` (binary): the bytes that the ids stand for; null ids give no bytes."""
    vocab = df.sparkSession.sparkContext.broadcast({i: b for b, i in ranks.items()})
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.BinaryType())])
    names = [f.name for f in schema.fields[:-1]]

    def run(batches):
        piece = vocab.value.__getitem__
        for batch in _slices(batches):
            col = batch.column(ids)
            got = [b"".join(map(piece, x.values.to_numpy(zero_copy_only=False).tolist())) if x.is_valid else b"" for x in col]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(got, pa.binary())], names=names + [out])

    return df.select(*[F.col(f"`{n}`") for n in dict.fromkeys([*names, ids])]).mapInArrow(run, schema)
