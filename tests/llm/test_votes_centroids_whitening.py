"""License votes, centroid clusters and whitening against plain Python and numpy, with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.llm import queries
from basketflow.llm.common import Stages

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


# ---------------------------------------------------------------- license votes

def license_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base_places(words):
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    return sorted((i, label) for label, p in phrases.items() for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p)


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\"), to deal in the Software without restriction")


def license_texts():
    r = random.Random(5)
    loose = ["all", "rights", "reserved", "general", "public", "license", "cc", "by", "é", "K", "x7"]
    texts = [None, "", " -- ", "CC-BY cc by\x00CC\tBY", "All rights reserved. all RIGHTS, reserved", "cc " * 50 + "by", "ALL rİghts reserved"]
    texts += [" ".join(r.choice(loose) for _ in range(r.randint(0, 60))) for _ in range(200)]
    texts += ["general public license " * 4000]
    # One word lost, one added, one replaced: the span goes over several diagonals.
    w = MIT.split()
    texts += ["intro " * 9 + MIT + " end", " ".join(w[:6] + w[7:]), " ".join(w[:9] + ["truly"] + w[9:]), " ".join(w[:12] + ["such"] + w[13:]), " ".join(w[:9])]
    return texts


@pytest.mark.parametrize("block", [4_096, 4])
def test_license_votes(spark, tmp_path, block):
    from basketflow.llm import licenses as li
    rows = [(None if i % 50 == 7 else i, t, "x") for i, t in enumerate(license_texts())] + [(3, "cc by", "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumnRenamed("row", "spans")
    found = li.templates() if block > 4 else [t for t in li.templates() if t.base]
    out = li.scan(docs, Stages(spark, "t"), found, block=block).collect()
    got = sorted((str(r._row.doc_id), r._row.text or "", r.n_words, [(s.start, s.label) for s in r.spans if s.base]) for r in out)
    want = sorted((str(i), t or "", len(license_words(t)), base_places(license_words(t))) for i, t, _ in rows)
    assert got == want
    assert all(s.end - s.start == s.words == s.covered for r in out for s in r.spans if s.base)
    if block > 4:
        by_text = {r._row.text: [(s.start, s.covered, s.words) for s in r.spans if s.label == "mit"] for r in out}
        whole, lost, added, other, short = license_texts()[-5:]
        n = len(license_words(MIT))
        assert by_text[whole] == [(9, n, n)] and by_text[lost] == [(0, n - 1, n)] and by_text[added] == [(0, n, n)]
        assert by_text[other] == [(0, n - 1, n)] and by_text[short] == []


def test_license_query_on_odd_rows(spark, tmp_path):
    folder = str(tmp_path / "d")
    spark.createDataFrame([(1, None), (1, ""), (None, "Licensed under CC BY-NC 4.0."), (2, "GNU General Public License, version 3. All rights reserved")],
                          "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = sorted((tuple(r) for r in queries.QUERIES["op11_license_votes"](spark, folder).collect()), key=str)
    assert got == sorted([(1, 0, 0, None, None, "", "", 0.0), (1, 0, 0, None, None, "", "", 0.0), (None, 7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0", 1.0),
                          (2, 9, 2, 1, 6, "gpl,reserved", "gpl,gpl-3.0,reserved", 1.0)], key=str)


def test_long_list_of_templates_is_refused():
    from basketflow.llm import licenses as li
    with pytest.raises(ValueError):
        li.templates(((" ".join(["w"] * (li.MAX_TEMPLATE_WORDS + 1)), "x"),))


# ---------------------------------------------------------------- centroid clusters

VECTORS = "vec_id long, embedding array<double>, label string, x string, cluster string"


def odd_vectors(seed, n, dims):
    r = random.Random(seed)
    rows = [(i, [round(r.uniform(-1.5, 1.5), 3) for _ in range(dims)]) for i in range(n)]
    rows += [(900, None), (901, []), (902, [1.0] * (dims - 1)), (903, [None] + [0.0] * (dims - 1)), (904, [NAN] + [0.0] * (dims - 1)),
             (905, [INF] + [0.0] * (dims - 1)), (None, [-0.001] * dims), (None, [0.25] * dims), (7, rows[7][1]), (7, [0.5] * dims), *[(2000 + i, rows[1][1]) for i in range(20)]]
    return rows


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, tuple(math.floor(64 * c) for c in v)) for i, v in rows if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(v) for _, v in sorted(kept, key=key)[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups: dict = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = {j: sum(d for _, c, d in placed if c == j) for j in range(k)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, own[c], sum(own.values()), sha[c]) for i, c, d in placed]


@pytest.mark.parametrize("n, k, dims", [(60, 16, 64), (40, 5, 6), (3, 64, 4)])
def test_centroid_clusters(spark, n, k, dims):
    from basketflow.llm import centroids as ce
    rows = odd_vectors(n, n, dims) if n > 7 else [(i, [float(i)] * dims) for i in range(n)]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], VECTORS)
    out = ce.cluster(df, Stages(spark, "t"), k=k, dims=dims).collect()
    got = [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out]
    assert sorted(got, key=str) == sorted(brute_clusters(rows, k, 3, dims), key=str)
    assert all(hashlib.sha256(",".join(map(str, r.centroid)).encode()).hexdigest() == r.centroid_sha256 for r in out)


def test_centroids_that_win_nothing_stay(spark):
    from basketflow.llm import centroids as ce
    x = spark.createDataFrame([(1, [0]), (2, [1])], "vec_id long, x array<bigint>")
    assert ce.moved(x, [[0], [100], [0], [3]]) == [[0], [100], [0], [3]]
    assert ce.moved(x, [[-5], [-9]]) == [[0], [-9]]


# ---------------------------------------------------------------- whitening

def brute_whitening(vectors, components):
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    n, total = len(x), [int(s) for s in x.sum(axis=0)]
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, total)) for row in x]
    return values, centred @ axes / np.sqrt(values), deviation, values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("fan", [32, 2])
def test_whitening(spark, monkeypatch, fan):
    from basketflow.llm import whitening as wh
    monkeypatch.setattr(wh, "FAN", fan)
    rng = np.random.default_rng(4)
    good = (rng.normal(size=(400, 20)) * np.linspace(2, .2, 20)) @ rng.normal(size=(20, 20))
    rows = [(i, v.tolist()) for i, v in enumerate(good)] + [(None, good[3].tolist()), (3, good[3].tolist())]
    bad = [(900, None), (901, []), (902, [1.0] * 19), (903, [None] * 20), (904, [NAN] * 20), (905, [INF] * 20)]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows + bad], VECTORS).repartition(8)
    out = wh.whiten(df, Stages(spark, "t"), components=12).collect()
    values, want, deviation, explained = brute_whitening([v for _, v in rows], 12)
    assert len(out) == len(rows)
    by_id = {r.vec_id: r for r in out if r.vec_id not in (None, 3)}
    got = np.array([by_id[i].whitened for i, _ in rows if i in by_id])
    want = np.array([w for (i, _), w in zip(rows, want) if i in by_id])
    sign = np.sign((got * want).sum(axis=0))
    assert np.allclose(got, want * sign, atol=1e-8)
    assert {i: int(by_id[i].deviation) for i in by_id} == {i: d for (i, _), d in zip(rows, deviation) if i in by_id}
    assert np.allclose(out[0].explained, explained, rtol=1e-9) and out[0].n == len(rows)
    assert all(r.identity_error == out[0].identity_error < 1e-9 for r in out)
    three = [r.whitened for r in out if r.vec_id in (None, 3)]
    assert len(three) == 3 and all(np.allclose(t, three[0]) for t in three)


def test_whitening_of_degenerate_tables(spark):
    from basketflow.llm import whitening as wh
    table = lambda rows: wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), Stages(spark, "t")).collect()
    assert table([]) == [] and table([(1, [])]) == [] and table([(1, [.5, .25])]) == [] and table([(i, [.5, .25]) for i in range(9)]) == []
    # Three rows in four dimensions span two directions.
    three = table([(1, [0.0] * 4), (2, [1.0, 0.0, 0.0, 0.0]), (3, [0.0, 2.0, 0.0, 0.0])])
    assert [len(r.whitened) for r in three] == [2, 2, 2] and three[0].identity_error < 1e-12
    # Large deviations stay exact beyond 64 bits.
    far = table([(i, [float(2 ** 30 * (i % 5)), 1.0]) for i in range(50)])
    total = sum(64 * 2 ** 30 * (i % 5) + 1_000_000 for i in range(50))
    assert {int(r.deviation) for r in far} == {(50 * (64 * 2 ** 30 * k + 1_000_000) - total) ** 2 for k in range(5)}


@pytest.mark.parametrize("name", ["random", "repeated", "close", "graded", "split", "one"])
def test_qd_solver(name):
    from basketflow.llm import whitening as wh
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(32, 32)))
    m = {"random": rng.normal(size=(80, 32)), "repeated": (q * np.repeat([4.0, 3, 2, 1], 8)) @ q.T, "close": (q * (1 + 1e-9 * np.arange(32))) @ q.T,
         "graded": rng.normal(size=(80, 32)) * 10.0 ** (-np.arange(32) / 8), "split": np.diag(np.repeat([3.0, 2, 1, 5], 8)), "one": rng.normal(size=(9, 1))}[name]
    r = np.linalg.qr(m, mode="r")
    squares, axes, trace = wh.directions(r, 32)
    assert np.allclose(np.sqrt(squares), np.linalg.svd(r, compute_uv=False)[:len(squares)], rtol=1e-12)
    assert np.abs(axes.T @ axes - np.eye(len(squares))).max() < 1e-11
    assert np.abs(m.T @ (m @ axes) - axes * squares).max() < 1e-11 * squares[0]
    assert math.isclose(trace, (m * m).sum(), rel_tol=1e-12)


def test_whitening_query(spark):
    rows = queries.QUERIES["op13_qd_whitening"](spark, SF).collect()
    n = rows[0].n
    y = np.zeros((n, 32))
    ids = {v: i for i, v in enumerate(sorted({r.vec_id for r in rows}))}
    for r in rows:
        y[ids[r.vec_id], r.component - 1] = r.whitened
    assert len(rows) == 32 * n == 32 * spark.read.parquet(f"{SF}/embeddings.parquet").where(F.col("embedding").isNotNull()).count()
    assert np.abs(np.cov(y.T, bias=True) - np.eye(32)).max() < 1e-9
