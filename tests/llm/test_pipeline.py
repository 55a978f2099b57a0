import pytest
from common import odd

import __spark_entry__ as entry
import corpus_pipeline as C
from oracle import of_spark, of_sql
from voxweave.llm import bpe, langid, pii, queries
from test_decontam import every_window
from test_jaccard import brute

SF = "/root/testdata/sf0.001"


def plain(rows, spark):
    """The stages' rows one by one, in Python where an operator has a plain form."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    ok = {r["doc_id"] for r in langid.identify(docs, langid.train(docs)).where("accepted").collect()}
    rows = [r for r in rows if r[0] in ok]
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute([(r[0], r[1]) for r in rows]):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    rows = [r for r in rows if find(r[0]) == r[0]]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d for d, _ in every_window([(r[0], r[1]) for r in rows], items)}
    rows = [r for r in rows if r[0] not in hit]
    seen, some = {}, []
    for r in rows:
        for a, z, kind, votes in pii.candidates(r[1]):
            seen[kind, votes] = seen.get((kind, votes), 0) + 1
            some.append((kind, r[1][a:z], *pii.around(r[1], a, z)))
    m = pii.fit([(k, v, n) for (k, v), n in seen.items()], some)
    c = bpe.Codec(bpe.read_ranks())
    return sorted((r[0], c.encode_slow(pii.redacted(r[1], m, pii.THRESHOLD).encode())) for r in rows)


def test_run(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = C.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in got) == plain(rows, spark)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_stages_take_odd_rows(spark):
    for rows in (odd(spark), odd(spark).limit(0)):
        for name, stage in C.STAGES:
            out = stage(spark, rows, SF)
            assert out.count() <= rows.count()
            if name != C.STAGES[-1][0]:
                assert out.columns == rows.columns


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries(spark, name):
    got = of_spark(queries.QUERIES[name](spark, SF))
    assert got[1]
    if name in queries.SQL:
        assert got == of_sql(queries.SQL[name])


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 11))
