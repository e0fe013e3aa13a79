"""Plain Python versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(s) -> str:
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def substring_dedup(rows, window=50):
    """rows of (doc_id, text) -> list of (doc_id, n_words, n_removed, kept_sha256)."""
    big = float("inf")
    first: dict = {}
    split = [(big if d is None else d, d, words_of(t)) for d, t in rows]
    for order, _, ws in split:
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            first[key] = min(first.get(key, big), order)
    out = []
    for order, d, ws in split:
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < order:
                gone[i:i + window] = [True] * window
        kept = [w for w, g in zip(ws, gone) if not g]
        out.append((d, len(ws), sum(gone), sha(" ".join(kept))))
    return out


def secrets(text):
    """(kind, start, end) of all base secrets, found by walking the characters; sorted by start, then kind as listed."""
    t, found = text or "", []
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    upper, digits, hexes = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    value = set(upper + upper.lower() + digits + "+/_.=-")

    def run(i, chars):
        while i < len(t) and t[i] in chars:
            i += 1
        return i

    i = 0
    while i < len(t):
        key = next((k for k in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(k, i)), None)
        end = i + 1
        if key:
            j = i + len(key)
            j = run(j + (t[j:j + 1] in ('"', "'")), " ")
            if t[j:j + 1] in (":", "="):
                j = run(j + 1, " ")
                j += t[j:j + 1] in ('"', "'")
                if run(j, value) > j:
                    end = run(j, value)
                    if end - j >= 8:
                        found.append((i, 0, "assign", end))
        i = end
    i = 0
    while i < len(t):
        j = run(i + 4, upper + digits) if t.startswith("AKIA", i) else i
        if j - i >= 16:
            found.append((i, 1, "access", j))
        i = max(i + 1, j if j > i + 4 else i + 1)
    i = 0
    while i < len(t):
        j = run(i, hexes)
        if j - i >= 32:
            found.append((i, 2, "hex", j))
        i = max(i + 1, j)
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def simhash(text, shingle=3):
    import xxhash
    ws = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words_of(text)]
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + shingle]) for i in range(max(1, len(ws) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    """The smallest id reachable from each position; linked(i, j) says whether two positions link."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    names: dict = {}
    for i, d in enumerate(ids):
        if d is not None:
            names[find(i)] = min(names.get(find(i), d), d)
    return [names.get(find(i)) for i in range(len(ids))]


def simhash_components(rows, max_bits=2):
    prints = [simhash(t) for _, t in rows]
    comps = components([d for d, _ in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= max_bits)
    return [(d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, comps)]


def cosine_links(rows, threshold=0.9):
    """rows of (vec_id, vector) -> list of (vec_id, n_links, component_id, kept)."""
    import math

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        norm = math.sqrt(math.fsum(x * x for x in v))
        return [x / norm for x in v]

    units = [unit(v) for _, v in rows]

    def linked(i, j):
        a, b = units[i], units[j]
        return bool(a and b and len(a) == len(b) and math.fsum(x * y for x, y in zip(a, b)) >= threshold)

    n = len(rows)
    links = [sum(linked(i, j) for j in range(n) if j != i) for i in range(n)]
    comps = components([d for d, _ in rows], linked)
    return [(d, k, c, d is not None and d == c) for (d, _), k, c in zip(rows, links, comps)]


def quality_measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t, ws = text or "", words_of(text)
    seen: set = set()
    dup = 0
    for line in t.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    count: dict = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    n = len(ws)
    return (n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n)


def _spark_hash(*values) -> int:
    """XXH64 as chained over columns with seed 42: strings by their bytes, longs as eight bytes."""
    import xxhash
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else (v % 2 ** 64).to_bytes(8, "little")
            seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed - 2 ** 64 if seed >= 2 ** 63 else seed


def quality_buckets(text, buckets):
    hs = [_spark_hash(w) for w in words_of(text)]
    return [h % buckets for h in hs] + [_spark_hash(h, n) % buckets for h, n in zip(hs, [*hs[1:], None])]


def line_dedup(rows):
    """rows of (doc_id, text) -> list of (doc_id, text, n_lines, n_removed); ids distinct."""
    first: dict = {}
    out = []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if t is None:
            out.append((d, None, 0, 0))
            continue
        lines = t.split("\n")
        worded = [i for i, x in enumerate(lines) if words_of(x)]
        gone = set()
        for a, b in zip(worded, worded[1:]):
            where, until = first.setdefault("\n".join(lines[a:b + 1]), (len(out), b))
            if where != len(out) or a > until:
                gone.update(range(a, b + 1))
        out.append((d, "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return out
