import math
import random

from common import odd

from voxweave.llm import kernels as K
from voxweave.llm import topk


def brute(docs, queries, k):
    words = [(d, K.words_of(t)) for d, t in docs if d is not None and t is not None]
    some = [w for _, w in words if w]
    n, mean = len(some), sum(map(len, some)) / max(1, len(some))
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for q, text in queries:
        if q is None or text is None:
            continue
        scored = []
        for d, w in words:
            s = 0
            for t in set(K.words_of(text)):
                if c := w.count(t):
                    s += math.floor(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(w) / mean)) * 1e6 + 0.5)
            if s:
                scored.append((-s, d))
        out += [(q, r + 1, d, -s / 1e6) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(1)
    zipf = lambda: f"w{int(400 * rng.random() ** 3)}"
    docs = [(d, " ".join(zipf() for _ in range(rng.randrange(0, 120)))) for d in range(300)]
    docs += [(1000 + d, t) for d, t in docs[:40]]
    queries = [(q, " ".join(zipf() for _ in range(rng.randrange(0, 30)))) for q in range(40)]
    a, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(queries, "item_id long, text string")
    for k in (1, 10, 1000):
        assert sorted(map(tuple, topk.search(a, b, k).collect())) == brute(docs, queries, k)
    old, topk.POSTINGS = topk.POSTINGS, 50
    try:
        assert sorted(map(tuple, topk.search(a.coalesce(1), b, 5, block_bytes=300).collect())) == brute(docs, queries, 5)
    finally:
        topk.POSTINGS = old


def test_stopping_early_changes_nothing():
    import numpy as np

    rng = np.random.default_rng(2)
    for trial in range(60):
        n = int(rng.integers(1, 200))
        row, term, impact = [], [], []
        for t in range(6):
            own = np.flatnonzero(rng.random(n) < rng.random())
            row += own.tolist()
            term += [t] * len(own)
            impact += (rng.pareto(1.5, len(own)) * 1000 + 1).astype(int).tolist()
        ix = topk.Index(np.arange(n) * 2, np.array(row, np.int64), np.array(term, np.int64), np.array(impact, np.int64), 6)
        terms = np.flatnonzero(rng.random(6) < 0.7)
        exact = np.zeros(n, np.int64)
        for r, t, i in zip(row, term, impact):
            if t in terms:
                exact[r] += i
        k = int(rng.integers(1, 12))
        floor = int(np.sort(exact)[-1 - int(rng.integers(0, n))]) if trial % 2 else 0
        rows, scores = ix.top(terms, k, floor)
        assert (exact[rows] == scores).all()
        best = sorted(((-s, d) for d, s in enumerate(exact.tolist()) if s and s >= floor))[:k]
        got = sorted((-s, d) for d, s in zip(rows.tolist(), scores.tolist()) if s >= floor)[:k]
        assert got == best


def test_odd_rows(spark):
    queries = spark.createDataFrame([(1, "hello words"), (1, "hello words"), (2, None), (3, ""), (None, "hello"), (4, "nothing of it"), (5, "palabra")], "item_id long, text string")
    df = odd(spark)
    got = sorted(map(tuple, topk.search(df, queries, 3).collect()))
    assert [g[:3] for g in got] == [(1, 1, 4), (1, 1, 4), (1, 2, 4), (1, 2, 4), (4, 1, 4), (4, 2, 4), (5, 1, 5)]
    assert topk.search(df.limit(0), queries).count() == 0 and topk.search(df, queries.limit(0)).count() == 0
