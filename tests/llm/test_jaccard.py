import itertools
import random

import numpy as np
from common import odd

from voxweave.llm import jaccard as J
from voxweave.llm import kernels as K


def corpus(seed, groups=25, most=12, words=80):
    """Groups of near copies, exact copies and strangers."""
    rng, out = random.Random(seed), []
    vocabulary = [f"w{k}" for k in range(3000)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(12, words))]
        for _ in range(rng.randrange(1, most)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            out.append(" ".join(w))
    rng.shuffle(out)
    return [(k * 3, t) for k, t in enumerate(out)]


def brute(rows, n=J.N, t=J.THRESHOLD):
    sets = {}
    for i, x in rows:
        w = K.words_of(x)
        if w:
            sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}
    return {(a, b): round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 6) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t}


def classes(rows, pairs):
    """{doc_id: (class_id, links)} from pairs."""
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = dict.fromkeys(parent, 0)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in parent}


def joined(spark, rows, **how):
    got = J.join(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()
    assert len(got) == len({i for i, _ in rows})
    return {r["doc_id"]: (r["class_id"], r["links"]) for r in got}


def test_join_against_brute_force(spark):
    rows = corpus(1)
    pairs = brute(rows)
    assert len(pairs) > 100
    assert joined(spark, rows, recall=0.9999) == classes(rows, pairs)


def test_groups_in_blocks(spark):
    """Groups larger than a cell are cut to blocks: the same result."""
    rows = corpus(9, groups=6, most=60, words=50)
    want = classes(rows, brute(rows))
    assert joined(spark, rows, recall=0.9999, cell=300) == want
    assert joined(spark, rows, recall=0.9999, cell=4000) == want


def test_one_of_each(spark):
    rows = corpus(2)
    kept = {r["doc_id"] for r in J.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute(rows):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {i for i, _ in rows if find(i) == i}
    assert want <= kept and len(kept - want) <= 1


def test_recall_is_planned():
    for t, recall in ((0.7, 0.995), (0.5, 0.9), (0.9, 0.99)):
        b, r = J.plan(t, recall)
        assert 1 - (1 - t**r) ** b >= recall > 1 - (1 - t**r) ** (b - 1)


def test_components(spark):
    rng = random.Random(4)
    edges = [(max(a, b), min(a, b)) for a, b in ((rng.randrange(300), rng.randrange(300)) for _ in range(220)) if a != b] + [(k + 1, k) for k in range(400, 440)]
    got = {r["node"]: r["label"] for r in J.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(parent)}


def test_settled_and_crossed():
    rng = np.random.default_rng(5)
    for m in (2, 3, 60):
        base = rng.permutation(400)[:60]
        sets = [np.unique(np.concatenate([base[: rng.integers(1, 60)], rng.integers(0, 400, rng.integers(1, 12))])) for _ in range(m)]
        copies = rng.integers(1, 5, m)
        j = np.array([[len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for b in sets] for a in sets])
        for t in (0.3, 0.6, 0.8):
            near = (j >= t) & ~np.eye(m, dtype=bool)
            first, links = J.settled(sets, copies, t)
            want = classes([(k, "") for k in range(m)], [(a, b) for a in range(m) for b in range(a) if near[a, b]])
            assert first.tolist() == [want[k][0] for k in range(m)] and links.tolist() == (near @ copies).tolist()
            cut = m // 3 + 1
            across = near.copy()
            across[:cut, :cut] = across[cut:, cut:] = False
            first, links = J.crossed(sets[:cut], sets[cut:], copies, t)
            want = classes([(k, "") for k in range(m)], [(a, b) for a in range(m) for b in range(a) if across[a, b]])
            assert first.tolist() == [want[k][0] for k in range(m)] and links.tolist() == (across @ copies).tolist()


def test_strangers_in_a_bucket_hide_nobody(spark):
    """Many short documents share a passage, so buckets are full of strangers with lower ids."""
    rng = random.Random(7)
    shared = " ".join(f"line{k}" for k in range(12))
    rows = [(k, " ".join(f"s{rng.randrange(10**6)}" for _ in range(14)) + " " + shared) for k in range(900)]
    for k in range(900, 960, 2):
        w = [f"p{rng.randrange(10**6)}" for _ in range(25)]
        rows += [(k, " ".join(w) + " " + shared), (k + 1, " ".join([*w[:-1], "other"]) + " " + shared)]
    pairs = brute(rows)
    assert set(pairs) == {(k, k + 1) for k in range(900, 960, 2)}
    assert joined(spark, rows) == classes(rows, pairs)


def test_crowds(spark):
    """A text repeated 10^5 times, 10^5 strangers that share a passage, 2000 near copies: no list, block or task holds them all."""
    rng = np.random.default_rng(8)
    m = 100_000
    words = rng.integers(0, 1 << 40, (m, 14))
    shared = " ".join(f"line{k}" for k in range(12))
    base = [f"b{k}" for k in range(60)]
    near = [" ".join([*base[:k], f"x{i}", *base[k + 1 :]]) for i, k in enumerate(rng.integers(0, 60, 2000).tolist())]
    rows = [(k, "the same words in the same order every time") for k in range(m)] + [(m + k, " ".join(map(str, w)) + " " + shared) for k, w in enumerate(words.tolist())] + [(2 * m + k, t) for k, t in enumerate(near)]
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "text"])).repartition(8)
    got = J.join(df).selectExpr("case when doc_id < 100000 then 'copy' when doc_id < 200000 then 'stranger' else 'near' end as kind", "class_id - doc_id as off", "class_id", "links")
    by = {r["kind"]: r for r in got.groupBy("kind").agg({"class_id": "max", "off": "min", "links": "min"}).collect()}
    most = {r["kind"]: r["max(links)"] for r in got.groupBy("kind").agg({"links": "max"}).collect()}
    assert by["copy"]["max(class_id)"] == 0 and by["copy"]["min(links)"] == most["copy"] == m - 1
    assert by["stranger"]["min(off)"] == 0 and most["stranger"] == 0
    assert by["near"]["max(class_id)"] == 2 * m and by["near"]["min(links)"] == most["near"] == 1999


def test_a_group_is_not_compared_with_itself_to_be_found(spark, monkeypatch):
    """A group of m near copies outside of each other's balls: some comparisons for each, not m^2 / 2 on full sets, and all links."""
    rng, compared, verified = random.Random(11), [], J._verified

    def counted(pairs, grams):
        compared.append(pairs.count())
        return verified(pairs, grams)

    monkeypatch.setattr(J, "_verified", counted)
    base, m = [f"b{k}" for k in range(100)], 300
    rows = []
    for k in range(m):
        w = list(base)
        for at in rng.sample(range(100), 3):
            w[at] = f"x{k} {at}"
        rows.append((k, " ".join(w)))
    pairs = brute(rows)
    assert len(pairs) > 0.4 * m * m
    assert joined(spark, rows) == classes(rows, pairs)
    assert sum(compared) < 0.25 * m * m


def test_main_group_meets_only_the_others(spark):
    """Of rows that share a key all pairs of unequal labels are made, once, and no others, however many blocks they fill."""
    rows = [(1, k, 10, False, 0, 0 if k < 1100 else k // 3) for k in range(1130)] + [(2, k, 10, False, 0, 7) for k in range(50)]
    df = spark.createDataFrame(rows, "value long, id long, size long, ball boolean, level int, label long")
    got = [(r["u"], r["v"]) for r in J._paired(J._parted(df, "value"), "value", 0.6).collect()]
    label = {i: g for v, i, _, _, _, g in rows if v == 1}
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in label for b in label if a > b and label[a] != label[b]}


def test_odd_rows(spark):
    df = odd(spark)
    got = J.join(df).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 3, 4, 5, 6, 7, 8] and all(r["class_id"] == r["doc_id"] and r["links"] == 0 for r in got)
    assert J.one_of_each(df).columns == df.columns and J.one_of_each(df).count() == df.count()
    assert J.join(df.limit(0)).count() == 0 and J.one_of_each(df.limit(0)).count() == 0
    same = [(3, "a b c d", "x"), (1, "A, b c d!", "x"), (2, "a b c d", "x"), (2, "a b c d", "x"), (9, "zz", "x"), (8, "zz", "x"), (8, "other words here now", "x"), (None, "a b c d", "x")]
    df = odd(spark, same)
    got = {r["doc_id"]: (r["class_id"], r["links"]) for r in J.join(df).collect()}
    assert got in ({1: (1, 2), 2: (1, 2), 3: (1, 2), 8: (8, 0), 9: (9, 0)}, {1: (1, 2), 2: (1, 2), 3: (1, 2), 8: (8, 1), 9: (8, 1)})
    assert {1, 8, None} <= {r["doc_id"] for r in J.one_of_each(df).collect()} <= {1, 8, 9, None}
