import random

from voxweave.operators import intervals as I

TURNS = [(1, 0, "A", 0, 6), (1, 1, "B", 6, 10), (1, 2, "C", 20, 30)]
SEGMENTS = [(1, 0, 0, 10, "X"), (1, 1, 10, 20, "Y"), (1, 2, 20, 30, "Z")]


def turns(spark, rows=TURNS):
    return spark.createDataFrame([(p, i, s, float(a), float(z)) for p, i, s, a, z in rows], "podcast_id long, turn_idx long, speaker string, start double, end double")


def segments(spark, rows=SEGMENTS):
    return spark.createDataFrame([(p, i, float(a), float(z), s) for p, i, a, z, s in rows], "podcast_id long, seg_idx long, start double, end double, speaker string")


def test_decisions(spark):
    seen = {r["seg_idx"]: r for r in I.reviewed(segments(spark), turns(spark), 1).collect()}
    assert (seen[0]["decision"], seen[0]["dominant"], seen[0]["purity"]) == ("split", "A", 0.6)
    assert (seen[1]["decision"], seen[1]["dominant"]) == ("keep", "Y")
    assert (seen[2]["decision"], seen[2]["dominant"]) == ("keep", "C")
    assert {r["seg_idx"]: r["decision"] for r in I.reviewed(segments(spark), turns(spark), 2).collect()} == {0: "drop", 1: "keep", 2: "keep"}


def test_review(spark):
    out = [(r["start"], r["end"], r["speaker"], r["split_from"]) for r in I.review(segments(spark), turns(spark), 1).orderBy("segment").collect()]
    assert out == [(0, 6, "A", 0), (10, 20, "Y", None), (20, 30, "C", None)]


def test_tie_goes_to_the_first_heard(spark):
    r = I.purity(I.overlaps(segments(spark, [(1, 0, 0, 10, "X")]), turns(spark, [(1, 0, "B", 0, 5), (1, 1, "A", 5, 10)]))).first()
    assert (r["dominant"], r["purity"]) == ("B", 0.5)


def test_buckets_give_the_same_pairs(spark):
    rng = random.Random(5)
    make = lambda n: [(rng.randrange(3), i, "S", a := rng.randrange(500), a + rng.randrange(1, 90)) for i in range(n)]
    t, s = turns(spark, make(80)), segments(spark, [(p, i, a, z, x) for p, i, x, a, z in make(60)])
    plain = sorted(map(tuple, I.overlaps(s, t).collect()))
    assert plain == sorted(map(tuple, I.overlaps(s, t, bucket=25).collect()))
    assert all(r["overlap"] > 0 for r in I.overlaps(s, t).collect())


def test_assignment_and_no_turns(spark):
    s = spark.createDataFrame([(1, 0, 0.0, None), (2, 0, 0.0, 9.0)], "podcast_id long, seg_idx long, start double, end double")
    assert {r["podcast_id"]: r["speaker"] for r in I.assigned(s, turns(spark)).collect()} == {1: "A", 2: "SPEAKER_00"}
    assert I.review(segments(spark), turns(spark).limit(0)).count() == 3


def plain_fill(chunks, most, least):
    out, now = [], 0.0
    for d in chunks:
        if now > 0 and now + d > most:
            if now >= least:
                out.append(now)
            now = 0.0
        now += d
        if now >= least and now >= 0.9 * most:
            out.append(now)
            now = 0.0
    while now > 0:
        part = min(most, now)
        if part >= least:
            out.append(part)
        now -= part
    return out


def test_fill(spark):
    rng = random.Random(3)
    all_chunks = {p: [float(rng.choice([1, 2, 3, 5, 8, 13, 40])) for _ in range(rng.randrange(1, 30))] for p in range(20)}
    df = spark.createDataFrame([(p, i, d) for p, c in all_chunks.items() for i, d in enumerate(c)], "podcast_id long, chunk_idx long, duration double")
    got = {}
    for r in I.filled(df, 15, 10).orderBy("podcast_id", "seg_idx").collect():
        got.setdefault(r["podcast_id"], []).append(r["duration"])
    assert got == {p: f for p, c in all_chunks.items() if (f := plain_fill(c, 15.0, 10.0))}


def test_fixed_and_by_turn(spark):
    r = spark.createDataFrame([(1, 40.0), (2, 24.0), (3, 0.0)], "podcast_id long, duration double")
    assert sorted((x["podcast_id"], x["start"], x["end"]) for x in I.fixed(r).collect()) == [(1, 0, 15), (1, 15, 30), (1, 30, 40), (2, 0, 15)]
    from pyspark.sql import functions as F

    out = I.by_turn(turns(spark, [(1, 0, "A", -5, 12), (1, 1, "B", 12, 20), (1, 2, "C", 20, 52)]), F.lit(50.0))
    assert sorted((x["start"], x["end"], x["speaker"]) for x in out.collect()) == [(0, 12, "A"), (20, 35, "C"), (35, 50, "C")]
