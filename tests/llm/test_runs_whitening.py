"""Periodic runs and whitening against brute force and plain numpy."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tillcast.llm import periodic, queries, whitening

WORD = re.compile("[^\x20\x09-\x0D]+")


def runs_by_hand(w, least=6, times=4):
    """Every stretch of every period, the smallest period of equal stretches."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, times * q):
                found.setdefault((s, i + q - s), q)
            i += i == s
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(draw, letters):
    w = []
    for _ in range(draw.randint(0, 14)):
        if draw.random() < 0.5:
            block = [draw.randrange(letters) for _ in range(draw.randint(1, 9))]
            w += block * draw.randint(1, 7) + block[:draw.randint(0, len(block))]
        else:
            w += [draw.randrange(letters + 1) for _ in range(draw.randint(1, 6))]
    return w


def test_runs_equal_brute_force():
    draw = random.Random(13)
    for _ in range(700):
        rows = [repetitive(draw, draw.choice([1, 2, 3, 9])) for _ in range(draw.randint(0, 4))]
        assert periodic.text_runs(rows) == [runs_by_hand(w) for w in rows]
        assert periodic.text_runs(rows, 4, 3) == [runs_by_hand(w, 4, 3) for w in rows]


def test_suffix_order():
    draw = random.Random(2)
    for _ in range(100):
        w = [draw.randrange(3) for _ in range(draw.randint(0, 60))] + [9]
        order, rank = periodic.suffix_order(np.array(w))
        assert order.tolist() == sorted(range(len(w)), key=lambda i: w[i:])
        assert rank[order].tolist() == list(range(len(w)))


def digest_by_hand(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_hand(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] * math.factorial(12) / r[2], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, n, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def digests(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def test_query_equals_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = digests(queries.QUERIES["op13_periodic_runs"](spark, folder))
    assert got == sorted((digest_by_hand(*r) for r in rows), key=repr)
    assert sum(g[2] > 0 for g in got) >= 5


def test_runs_of_odd_texts(edge, empty, edge_rows, spark):
    def of(df):
        return digests(periodic.run_digests(periodic.periodic_runs(periodic.repeat_tails(df))))
    assert of(edge) == sorted((digest_by_hand(r[0], r[1]) for r in edge_rows), key=repr)
    assert of(empty) == []
    # Ids whose texts are repeated, by the rule or by themselves; ties in length / period; words that only differ in letter case.
    ids = [k for k in range(300) if zlib.crc32(str(k).encode()) % 10 == 0][:20]
    draw = random.Random(5)
    rows = [(k, " ".join(draw.choice(["a", "b", "A"]) for _ in range(draw.randint(0, 90)))) for k in ids + list(range(20))]
    rows += [(None, "x " * 9), (-7, "a a a a a a b b b b b b"), (-7, "a a a a a a b b b b b b"), (-8, "ab " * 8), (-9, "ab  " * 8), (-10, "\x1c\x1d \x85 " * 6)]
    assert of(spark.createDataFrame(rows, "doc_id long, text string")) == sorted((digest_by_hand(*r) for r in rows), key=repr)


def test_very_long_texts():
    n = 300_000
    assert periodic.text_runs([[0] * n]) == [[(0, n, 1)]]
    assert periodic.text_runs([[i % 50_000 for i in range(n)]]) == [[(0, n, 50_000)]]
    draw = random.Random(1)
    coins = [draw.randrange(2) for _ in range(60_000)]
    assert [r for r in periodic.text_runs([coins])[0] if r[2] <= 3] == [r for r in short_runs(coins, 3)]


def short_runs(w, most):
    found = {}
    for q in range(1, most + 1):
        same = np.r_[np.array(w[:-q]) == np.array(w[q:]), False]
        edges = np.flatnonzero(np.diff(np.r_[False, same, False].astype(int)))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e + q - s >= max(6, 4 * q):
                found.setdefault((s, e + q - s), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def whitened_by_hand(vectors):
    """n, exact deviations, whitened values up to the sign, shares: numpy's own eigenvectors."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    off = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in fit])
    cov = off.T @ off / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    rows = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return n, deviation, rows, values, axes, np.trace(cov)


def check(found, ids, vectors, most=16):
    n, deviation, rows, values, axes, trace = whitened_by_hand(vectors)
    k = min(most, int((values > values[0] * len(values) * 1e-13).sum()))
    got = {}
    for r in found:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(found) == len(ids) * k and set(got) == set(ids)
    want = rows @ axes[:, :k] / np.sqrt(values[:k])
    for c in range(k):
        column = np.array([got[i][c + 1].whitened for i in ids])
        assert np.allclose(column, want[:, c] * np.sign(column @ want[:, c]), atol=1e-8)
        assert all(abs(got[i][c + 1].explained / (values[c] / trace) - 1) < 1e-9 for i in ids)
    for i, d in zip(ids, deviation):
        assert got[i][1].deviation == d and got[i][1].n == n
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_whitening_equals_numpy(spark, folder):
    rows = duckdb.sql(f"select vec_id, embedding from '{folder}/embeddings.parquet' where embedding is not null").fetchall()
    found = queries.QUERIES["op12_embedding_whitening"](spark, folder).collect()
    check(found, [r[0] for r in rows], [r[1] for r in rows])


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(k, [float(c) for c in rng.standard_normal(20) * 3 ** (np.arange(20) % 5)]) for k in range(60)]
    good += [(100 + k, good[7][1]) for k in range(40)]  # copies count once in the fit
    bad = [(200, None), (201, [float("nan")] + [0.0] * 19), (202, [float("inf")] * 20), (203, [None] + [1.0] * 19), (204, []), (205, [1.0] * 3), (206, [1e30] * 20)]
    df = spark.createDataFrame([(k, v, "c", 1, 2.0) for k, v in good + bad], "vec_id long, embedding array<float>, id string, x int, whitened double").repartition(5)
    check(whitening.whitened(df).collect(), [k for k, _ in good], [v for _, v in good])
    assert whitening.whitened(df.limit(0)).count() == 0
    assert whitening.whitened(df.filter("vec_id = 3")).count() == 0  # one vector has no variance
    assert whitening.whitened(df.filter("vec_id >= 204")).count() == 0
    few = df.filter("vec_id < 4")  # four vectors span three dimensions
    check(whitening.whitened(few).collect(), [0, 1, 2, 3], [v for k, v in good if k < 4])
    twice = df.filter("vec_id < 60").unionByName(spark.createDataFrame([(None, good[3][1], "c", 1, 2.0), (5, good[5][1], "c", 1, 2.0)], df.schema))
    out = whitening.whitened(twice).collect()
    assert len(out) == 62 * 16 and sum(r.vec_id is None for r in out) == 16 and sum(r.vec_id == 5 for r in out) == 32 and out[0].n == 60


def test_large_numbers_stay_exact():
    m = whitening.Moments(3, [3_000_001, 5], np.eye(2))
    x = np.array([[1_000_000, 1], [1 << 40, -(1 << 40)]])
    want = [sum((3 * c - s) ** 2 for c, s in zip(row, m.sums)) for row in x.tolist()]
    assert whitening._deviations(x, m) == [want[0], None if want[1] >= 1 << 63 else want[1]]


@pytest.mark.parametrize("shape", ["spread", "equal", "near", "rank", "scaled"])
def test_no_eigenvalue_is_missed(shape):
    rng = np.random.default_rng(11)
    for _ in range(12):
        d = int(rng.integers(2, 60))
        values = {"spread": rng.random(d), "equal": np.repeat(rng.random(4), 15)[:d], "near": 1 + 1e-10 * rng.random(d),
                  "rank": np.r_[rng.random(d // 2 + 1), np.zeros(d)][:d], "scaled": 10.0 ** rng.uniform(-12, 6, d)}[shape]
        axes = np.linalg.qr(rng.standard_normal((d, d)))[0]
        v = axes * values @ axes.T
        v = (v + v.T) / 2
        true = np.linalg.eigvalsh(v)[::-1]
        for s in rng.uniform(-true[0], true[0] * 1.1, 4):
            assert whitening.count_above(v, s) == (true > s).sum()
        found = [whitening.feast(v, *cut) for cut in whitening.intervals(v, 16)]
        got = np.sort(np.concatenate([f.values for f in found]))[::-1]
        k = min(16, d)
        assert len(got) >= k and np.allclose(got[:k], true[:k], atol=true[0] * 1e-13)
        for f in found:
            assert np.abs(v @ f.vectors - f.vectors * f.values).max() <= 1e-11 * true[0]
