import random

import numpy as np
import pyarrow as pa
from common import odd

from voxweave.llm import decontam as D
from voxweave.llm import kernels as K


def items(rng, n=30):
    return [(k, " ".join(f"i{rng.randrange(400)}" for _ in range(rng.randrange(10, 40)))) for k in range(n)]


def docs(rng, its, n=120):
    out, planted = [], set()
    for d in range(n):
        w = [f"i{rng.randrange(400)}" if rng.random() < 0.3 else f"d{rng.randrange(2000)}" for _ in range(rng.randrange(0, 300))]
        if d % 4 == 0:
            k, t = rng.choice(its)
            t = t.split()
            if d % 8 == 0:
                t[rng.randrange(len(t))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = t
            planted.add((d, k))
        out.append((d, " ".join(w)))
    return out, planted


def test_planted_items_are_found_and_nothing_else(spark):
    rng = random.Random(1)
    its = items(rng)
    rows, planted = docs(rng, its)
    a, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(its, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.matches(a, b).collect()}
    assert got == planted
    assert sorted(map(tuple, D.matches(a, b, block_bytes=1500).collect())) == sorted(map(tuple, D.matches(a, b).collect()))
    kept = {r["doc_id"] for r in D.clean(a, b).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in planted}


def test_all_prints_within_the_radius_are_found():
    rng = np.random.default_rng(2)
    ix = D.build([(k, " ".join(f"w{x}" for x in rng.integers(0, 99, 20))) for k in range(60)])
    near = ix.prints[rng.integers(0, 60, 300)]
    for k in range(300):
        for bit in rng.choice(64, rng.integers(0, 30), replace=False):
            near[k] ^= np.uint64(1) << np.uint64(bit)
    for radius in (0, 3, 11, 23):
        w, i = D.within(ix, near, radius)
        want = {(a, b) for a in range(300) for b in range(60) if int(near[a] ^ ix.prints[b]).bit_count() <= radius}
        assert set(zip(w.tolist(), i.tolist())) == want


def every_window(rows, its):
    """{(document, item): (similarity, start)} of the best of all windows, in plain Python."""
    cut = lambda w: {tuple(w[j : j + 3]) for j in range(max(1, len(w) - 2))} if w else set()
    known = {k: K.words_of(t) for k, t in its}
    weight = {}
    for w in known.values():
        for g in cut(w):
            weight[g] = weight.get(g, 0) + 1
    weight = {g: np.log1p(len(its) / n) for g, n in weight.items()}
    default, want = np.log1p(len(its)), {}
    for d, t in rows:
        w = K.words_of(t)
        every = cut(w)
        for k, x in known.items():
            if len(x) >= 3 and not every & cut(x):
                continue
            own, least = cut(x), D.THRESHOLD if len(x) >= D.WHOLE_BELOW else 1
            for s in range(max(1, len(w) - len(x) + 1)):
                sh = cut(w[s : s + len(x)])
                score = round(sum(weight[g] for g in sh & own) / max(1e-9, sum(weight.get(g, default) for g in sh | own)), 6)
                if score >= least and score > want.get((d, k), (0, 0))[0]:
                    want[d, k] = (score, s)
    return want


def test_against_every_window():
    """The best window over all starts, exactly. What has no window within the radius, and only that, is missed."""
    lost = total = 0
    for seed in range(5):
        rng = random.Random(seed)
        its = [*items(rng), (90, "yes"), (91, "i7 i8"), (92, "i1 i2 i3 i4 i5")]
        rows, _ = docs(rng, its, 60)
        ix = D.build(its)
        ids = ix.ids.tolist()
        found = {(r, ids[i]): (s, a) for r, i, a, _, s in D.search(ix, pa.array([t for _, t in rows]), D.N, D.THRESHOLD, D.RADIUS)}
        every = {(r, ids[i]): (s, a) for r, i, a, _, s in D.search(ix, pa.array([t for _, t in rows]), D.N, D.THRESHOLD, 64)}
        want = every_window(rows, its)
        assert every == want and set(found.items()) <= set(want.items())
        lost, total = lost + len(want) - len(found), total + len(want)
    assert total > 60 and lost <= 0.01 * total


def test_short_items_are_searched():
    its = [(1, "yes"), (2, "of france"), (3, "what is the capital of france"), (4, "un deux trois quatre cinq six sept huit")]
    ix = D.build(its)
    texts = ["What is the capital of France?", "what is the capital of spain", "Yes, yes.", "the south of france", "of", None, "un deux trois quatre cinq six sept neuf"]
    got = sorted((r, its[i][0], a, z, s) for r, i, a, z, s in D.search(ix, pa.array(texts), D.N, D.THRESHOLD, D.RADIUS))
    assert [g for g in got if g[0] < 6] == [(0, 2, 4, 2, 1.0), (0, 3, 0, 6, 1.0), (2, 1, 0, 1, 1.0), (3, 2, 2, 2, 1.0)]
    assert [g[:4] for g in got if g[0] == 6] == [(6, 4, 0, 8)]


def test_ties_give_the_first_window():
    ix = D.build([(1, "a b c d e f g h")])
    text = "x a b c d e f g h y y a b c d e f g h"
    assert D.search(ix, pa.array([text]), D.N, D.THRESHOLD, D.RADIUS) == [(0, 0, 1, 8, 1.0)]


def test_odd_rows(spark):
    its = spark.createDataFrame([(1, None), (None, "hello world this is a plain sentence of words"), (2, ""), (3, "too short"), (4, "hello world this is a plain sentence of words"), (4, "hello world this is a plain sentence of words")], "item_id long, text string")
    df = odd(spark)
    got = [(r["doc_id"], r["item_id"], r["start_word"], r["n_words"], r["similarity"]) for r in D.matches(df, its).collect()]
    assert got == [(4, 4, 0, 9, 1.0)]
    assert D.clean(df, its).count() == df.count() - 2 and D.clean(df, its).columns == df.columns
    for a, b in ((df.limit(0), its), (df, its.limit(0)), (df, its.where("item_id = 2"))):
        assert D.matches(a, b).count() == 0
