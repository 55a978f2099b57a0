import numpy as np
from common import odd

from voxweave.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = Q.train(docs, labels.where("doc_id % 2 = 0"))
    got = Q.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = [r["high_quality"] == (r["quality"] == 1) for r in got]
    good = [r["high_quality"] for r in got if r["quality"] == 1]
    low = [not r["high_quality"] for r in got if r["quality"] == 0]
    assert len(got) > 100 and np.mean(right) > 0.95 and np.mean(good) > 0.98 and np.mean(low) > 0.75


def test_a_score_is_the_dot_product(spark):
    import pyarrow as pa

    texts = pa.array(["one two two", "!! ##", None, "two one", "  "])
    rng = np.random.default_rng(1)
    m = Q.Model(12, rng.normal(size=1 << 12).astype(np.float32), 0.3)
    got = Q.scores(m, texts)
    for i, j, buckets, values, splits in Q.features(texts, 12):
        for k in range(i, j):
            b, v = buckets[splits[k] : splits[k + 1]], values[splits[k] : splits[k + 1]]
            want = 1 / (1 + np.exp(-(m.weights[b] @ v + 0.3))) if len(b) else 0
            assert np.isclose(got[k], want)
            assert not len(b) or np.isclose((v * v).sum(), 1)


def plain_ftrl(rows, targets, epochs):
    """The update rule coordinate by coordinate: McMahan et al. 2013, algorithm 1."""
    z, n, w = {}, {}, {}
    many = [targets.count(0), targets.count(1)]
    for _ in range(epochs):
        for x, y in zip(rows, targets):
            x = [*x, ("bias", 1.0)]
            for k, _ in x:
                a = z.get(k, 0.0)
                w[k] = 0.0 if abs(a) <= Q.L1 else -(a - (Q.L1 if a > 0 else -Q.L1)) / ((Q.BETA + n.get(k, 0.0) ** 0.5) / Q.ALPHA + Q.L2)
            p = 1 / (1 + np.exp(-sum(w[k] * v for k, v in x)))
            for k, v in x:
                g = (p - y) * v * len(targets) / 2 / many[y]
                sigma = ((n.get(k, 0.0) + g * g) ** 0.5 - n.get(k, 0.0) ** 0.5) / Q.ALPHA
                z[k] = z.get(k, 0.0) + g - sigma * w[k]
                n[k] = n.get(k, 0.0) + g * g
    return {k: 0.0 if abs(a) <= Q.L1 else -(a - (Q.L1 if a > 0 else -Q.L1)) / ((Q.BETA + n[k] ** 0.5) / Q.ALPHA + Q.L2) for k, a in z.items()}


def test_training_and_scores_against_plain_ftrl(spark):
    """The whole operator: examples in order of their hash, plain words, plain updates, plain dot products."""
    import random
    import re

    import pyarrow as pa
    from pyspark.sql import functions as F

    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(("good", "fine", "text", "and", "more") if k % 3 else ("bad", "!!", "$$$", "and", "more")) for _ in range(rng.randrange(1, 30))), int(k % 3 > 0)) for k in range(60)] + [(60, None, 1), (61, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = Q.train(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    of = lambda g: int(next(Q.features(pa.array([g]), Q.BITS, 1))[2][0])

    def plain(text):
        words, out = re.findall(r"\w+|[^\w\s]+", text or ""), {}
        for w in words:
            out[w] = out.get(w, 0) + 1
        for a, b in zip(words, words[1:]):
            out[a, b] = out.get((a, b), 0) + 1
        total = sum(out.values())
        return [(k, (v / total) ** 0.5) for k, v in out.items()]

    order = df.orderBy(F.xxhash64("doc_id", F.lit(1))).collect()
    want = plain_ftrl([plain(r["text"]) for r in order], [r["quality"] for r in order], Q.EPOCHS)
    for w in ("good", "bad", "$$$", "more"):
        assert np.isclose(model.weights[of(w)], want.get(w, 0), atol=1e-5)
    assert np.isclose(model.bias, want["bias"], atol=1e-5)
    got = {r["doc_id"]: r["score"] for r in Q.score(df, model).collect()}
    for k, t, _ in rows:
        x = plain(t)
        assert np.isclose(got[k], 1 / (1 + np.exp(-(want["bias"] + sum(want.get(g, 0) * v for g, v in x)))) if x else 0, atol=1e-4)


def test_words():
    import pyarrow as pa

    from voxweave.llm import kernels as K

    texts = ["Price!!$$$ now", "a.b", "", None, "x", "!", " \n\t", "é, Ñ"]
    raw, off = K.buffers(pa.array(texts))
    w = Q.tokens(raw, off)
    said = [[raw[a:z].tobytes().decode() for a, z in zip(w.starts[w.splits[k] : w.splits[k + 1]], w.ends[w.splits[k] : w.splits[k + 1]])] for k in range(len(texts))]
    assert said == [["Price", "!!$$$", "now"], ["a", ".", "b"], [], [], ["x"], ["!"], [], ["é", ",", "Ñ"]]


def test_ftrl_separates_and_is_sparse():
    rng = np.random.default_rng(2)
    rows, ys = [], []
    for _ in range(400):
        y = int(rng.integers(2))
        b = np.unique(np.append(rng.integers(100, 4000, 20), y))
        rows.append((b, np.full(len(b), 1 / np.sqrt(len(b)))))
        ys.append(y)
    m = Q.ftrl(rows, ys, 12, epochs=5)
    assert m.weights[1] > 1 > -1 > m.weights[0] and (m.weights == 0).mean() > 0.3


def test_odd_rows(spark):
    df = odd(spark)
    labels = spark.createDataFrame([(4, 1, 0, "c"), (5, 0, 0, "c"), (4, 1, 0, "c"), (99, 1, 0, "c"), (None, 1, 0, "c"), (7, None, 0, "c")], "doc_id long, quality int, toxic int, text string")
    got = Q.score(df, Q.train(df, labels)).collect()
    assert len(got) == df.count() and all(r["score"] == 0 and not r["high_quality"] for r in got if r["doc_id"] in (1, 2, 3))
    none = {r["score"] for r in Q.score(df, Q.train(df, labels.limit(0))).collect()}
    assert none == {0.0, 0.5}
    assert Q.score(df.limit(0), Q.train(df.limit(0), labels)).count() == 0
