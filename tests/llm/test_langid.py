import math
import random
import tracemalloc

import pyarrow as pa
from common import ODD, odd

from voxweave.llm import langid as L

SF = "/root/testdata/sf0.01"


def plain_phrases(text: bytes, corpus: bytes) -> int:
    count, at = 0, 0
    while at < len(text):
        n = 0
        while at + n < len(text) and text[at : at + n + 1] in corpus:
            n += 1
        count, at = count + 1, at + max(1, n)
    return count


def test_rates_against_plain_parsing():
    rng = random.Random(1)
    letters = "abcde éß"
    say = lambda n: "".join(rng.choice(letters) for _ in range(n))
    model = L.Model({"x": fold(say(300)), "y": fold(say(200))})
    texts = [say(rng.randrange(0, 90)) for _ in range(60)] + ["zzz", "Abc! 12 dE", "ÉÉ  ß", "", "  "]
    texts += [say(9000), say(12_000)]  # walked by themselves beyond what others have
    rate, length = L.rates(model, pa.array(texts))
    for k, t in enumerate(texts):
        f = fold(t)
        assert length[k] == len(f)
        for j, lang in enumerate(model.langs):
            c = plain_phrases(f, model.texts[lang])
            assert math.isclose(rate[k, j], c * math.log2(len(model.texts[lang]) + 1) / max(1, len(f)))


def test_tables_take_little_more_than_they_hold():
    """What makes an automaton and folds is no multiple of the tables that are kept, nor are another model's tables held meanwhile."""
    rng = random.Random(3)
    say = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(1, 8))) for _ in range(9000)).encode()
    L.tables(L.Model({"a": say(), "b": say()}))
    model = L.Model({"c": say(), "d": say()})
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    kept = L.tables(model).step.nbytes
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert list(L._tables) == [model.digest] and peak < 2.5 * kept


def fold(t: str) -> bytes:
    from voxweave.llm import kernels as K

    return L.fold(*K.buffers(pa.array([t])))[0].tobytes()


def test_fold():
    assert fold("  Ab,  C-3d ÉÑ. ") == "ab c d éñ".encode()
    from voxweave.llm import kernels as K

    data, off = L.fold(*K.buffers(pa.array(["a ", " b", None, "..", "c"])))
    assert data.tobytes() == b"abc" and off.tolist() == [0, 1, 2, 2, 2, 3]


def test_accuracy_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.identify(docs, L.train(docs)).join(docs.select("doc_id", docs["lang"].alias("said")), "doc_id").collect()
    assert sum(r["lang"] == r["said"] for r in got) / len(got) > 0.97
    assert sum(r["accepted"] for r in got) >= 0.99 * len(got)


FOREIGN = [
    "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Ahi quanto a dir qual era e cosa dura",
    "Litwo, ojczyzno moja, ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił. Dziś piękność twą w całej ozdobie",
    "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander te gedragen",
    "Ainda que eu falasse as línguas dos homens e dos anjos, e não tivesse amor, seria como o metal que soa ou como o sino que tine",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
]


def test_other_languages_and_noise_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.train(docs.where("doc_id % 2 = 0"))
    rng = random.Random(5)
    noise = [" ".join(f"{rng.getrandbits(64):016x}" for _ in range(20)), "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(400))]
    got = L.identify(spark.createDataFrame(list(enumerate([*FOREIGN, *noise])), "doc_id long, text string"), model).collect()
    assert not any(r["accepted"] for r in got)
    rest = L.identify(docs.where("doc_id % 2 = 1"), model).collect()
    assert sum(r["accepted"] for r in rest) >= 0.99 * len(rest)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.train(docs.where("doc_id % 2 = 0"))
    rest = docs.where("doc_id % 2 = 1")
    got = L.identify(rest, model).join(rest.select("doc_id", rest["lang"].alias("said")), "doc_id").collect()
    assert sum(r["lang"] == r["said"] for r in got) / len(got) > 0.96


def test_odd_rows_and_rejection(spark):
    model = L.train(spark.read.parquet(f"{SF}/documents.parquet"))
    df = odd(spark, [*ODD, (20, "xq zv kjw pfq wwx qqz vvk", "en"), (21, "Of the and that with", "en")])
    got = {r["doc_id"]: r for r in L.identify(df, model).collect()}
    assert all(got[k]["lang"] is None and not got[k]["accepted"] for k in (1, 2, 3, 6)) and not got[7]["accepted"]
    assert not got[20]["accepted"] and got[21]["accepted"]
    kept = L.accepted(df, model)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in L.identify(df, model).where("accepted").collect()}
    assert L.identify(df.limit(0), model).count() == 0 and L.accepted(df.limit(0), model).count() == 0


def test_ties_and_short_training(spark):
    df = odd(spark, [(1, "same words here", "b"), (2, "same words here", "a"), (3, None, "c"), (4, "some", None)])
    model = L.train(df)
    assert model.langs == ["a", "b"]
    got = {r["doc_id"]: r for r in L.identify(df, model).collect()}
    assert got[1]["lang"] == "a" and got[1]["margin"] == 0
    none = L.train(df.limit(0))
    assert {r["doc_id"]: (r["lang"], r["accepted"]) for r in L.identify(df, none).collect()} == {1: (None, True), 2: (None, True), 3: (None, False), 4: (None, True)}
    assert {r["doc_id"] for r in L.accepted(df, none).collect()} == {1, 2, 4} and L.accepted(df.limit(0), none).count() == 0


def test_languages_of_many_copies_are_trained(spark):
    from pyspark.sql import functions as F

    texts = [(f"l{k:02}", f"some words of text {k} {j}") for k in range(24) for j in range(1 + k % 2)]
    df = spark.createDataFrame(texts, "lang string, text string").withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("c")
    df = df.unionByName(spark.createDataFrame([("empty", ""), ("null", None), (None, "unsaid")], "lang string, text string"))
    assert L.train(df).langs == sorted({g for g, _ in texts})
    many = spark.range(3000).selectExpr("'x' AS lang", "concat('words ', id) AS text")
    few = L.train(many, sample_rows=5, held_rows=7).texts["x"]
    order = many.withColumn("o", F.pmod(F.xxhash64("text"), F.lit(1 << 61))).orderBy("o").limit(5).collect()
    assert few == b" ".join(fold(r["text"]) for r in order)
