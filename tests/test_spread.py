"""Work on files: over tasks by rows, in batches of few bytes, without contents in joins."""

import numpy as np
import pandas as pd
import pytest

from voxweave import queries as Q
from voxweave.operators import catalog as L
from voxweave.operators import signal as S
from voxweave.operators import spread as D
from voxweave.sources import tables as R


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_by_rows(spark, tmp_path):
    spark.range(5000).withColumnRenamed("id", "p_partkey").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert Q._sounds(spark, str(tmp_path)).rdd.getNumPartitions() == 3
    assert D.spread(spark.range(0)).rdd.getNumPartitions() == 1


def test_batches_are_of_few_bytes(monkeypatch):
    monkeypatch.setattr(D, "BATCH_BYTES", 100)
    made = []
    rows = (made.append(k) or (k, b"x" * k) for k in [10, 50, 60, 300, 1])
    batches = D.in_batches(rows, ["k", "content"])
    assert list(next(batches)["k"]) == [10, 50] and made == [10, 50, 60]
    assert [list(b["k"]) for b in batches] == [[60], [300], [1]]
    monkeypatch.setattr(D, "BATCH_ROWS", 2)
    assert [len(b) for b in D.in_batches(((k,) for k in range(5)), ["k"])] == [2, 2, 1]
    assert isinstance(next(D.in_batches([(1,)], ["k"])), pd.DataFrame)


def test_downloads_are_figured_in_one_pass(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    got = Q.download_figures(spark, str(tmp_path))
    assert plan(got).count("MapInPandas") == 1
    assert got.first().asDict() == {"downloads": 10, "succeeded": 6, "failed": 4, "terminal": 2, "tries": 14}
    wanted = spark.createDataFrame([("a", "u/2"), ("b", "u/5")], "id string, url string")
    for keep in (True, False):
        rows = {r["id"]: (r["ok"], r["content"]) for r in L.downloaded(wanted, Q._fetch, keep=keep).collect()}
        assert rows == {"a": (True, bytearray(b"xx") if keep else None), "b": (False, None)}


def test_recordings_are_rows(spark):
    """Not groups of Python's: with a file, without one, with one that can't be read, with one that is null, and of several the first; a null name is a name."""
    wav = S.encode_wav(np.full(4000, 0.5), 100)
    files = spark.createDataFrame([("a", wav), ("b", b"no"), ("c", None), ("e", wav), (None, wav)], "podcast_id string, content binary")
    parts = [(p, k, float(k), k + 1.0) for p in ("a", "b", "c", "d", None) for k in (1, 0)]
    out = S.cut_files(spark.createDataFrame(parts, "podcast_id string, seg_idx long, start double, end double"), files)
    assert "CoGroup" not in plan(out) and "Join" not in plan(out)
    got = sorted(((str(r["podcast_id"]), r["seg_idx"], r["content"] and len(r["content"]), r["error"]) for r in out.collect()), key=lambda r: r[:2])
    assert [(r[0], r[1], r[2]) for r in got] == [(p, k, n) for p, n in (("None", 244), ("a", 244), ("b", None), ("c", None), ("d", None)) for k in (0, 1)]
    assert {r[0]: r[3] for r in got} == {"None": None, "a": None, "b": "not sound of a known format", "c": "not sound of a known format", "d": "no file"}
    turns = spark.createDataFrame([("a", 0, 0.0, 40.0, "A"), ("d", 1, 20.0, 31.0, "B"), ("d", 0, 0.0, 16.0, "A")], "podcast_id string, turn_idx int, start double, end double, speaker string")
    cut = S.split_turns(turns, files)
    assert "CoGroup" not in plan(cut)
    rows = sorted(tuple(r) for r in cut.select("podcast_id", "seg_idx", "start", "end", "speaker", "error").collect())
    assert rows == [("a", 0, 0.0, 14.0, "A", None), ("a", 1, 14.0, 28.0, "A", None), ("a", 2, 28.0, 40.0, "A", None), ("d", 0, 0.0, 15.0, "A", "no file"), ("d", 1, 20.0, 31.0, "B", "no file")]


def test_validation_joins_nothing(spark):
    """Each file is a row from probe to repair, also where two have a path."""
    good, short = S.encode_wav(np.full(32_000, 0.5), 16_000), S.encode_wav(np.full(60, 0.5), 100)
    files = spark.createDataFrame([("a", good), ("b", short), ("c", b"no"), ("d", None), ("b", short)], "path string, content binary")
    out = R.validated_files(files)
    assert not any(x in plan(out) for x in ("Join", "Exchange"))
    got = sorted((r["path"], r["valid"], r["message"], r["repaired"], r["content"] and len(r["content"])) for r in out.collect())
    assert got == [("a", True, "ok", None, None), ("b", False, "too small", True, 19244), ("b", False, "too small", True, 19244), ("c", False, "too small", False, None), ("d", False, "too small", False, None)]


def test_titles_match_row_by_row(spark, monkeypatch):
    """Each pair of rows once, as a join of both tables gives it, however many rows have a text; and over several tasks."""
    titles = [(1, "red bolt"), (2, "red bolt"), (2, "red bolt"), (3, "the red bolt and more of it"), (4, "blue"), (5, ""), (6, None)]
    files = [("x", "the red bolt 5"), ("x", "the red bolt 5"), ("y", "the red bolt and more of another"), ("z", "b"), ("w", ""), ("v", None)]
    a, b = spark.createDataFrame(titles, "id long, title string"), spark.createDataFrame(files, "path string, name string")
    want = sorted((i, p) for i, t in titles for p, n in files if t and n and (t[:20] in n or n[:20] in t))
    assert sorted(tuple(r) for r in L.matching_titles(a, b).collect()) == want
    monkeypatch.setattr(L, "PAIRS", 2)
    assert sorted(tuple(r) for r in L.matching_titles(a, b).collect()) == want


@pytest.mark.parametrize("small", [0, 1 << 14])
def test_the_fold_is_a_stream(spark, monkeypatch, small):
    """In batches and blocks as one meeting after the other: close scores, equal vectors, embeddings that aren't valid or of another length, several banks."""
    from voxweave.operators import speakers as P

    monkeypatch.setattr(P.Bank, "SMALL", small)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 8))
    es = [(centres[rng.integers(40)] + 0.3 * rng.standard_normal(8)).tolist() for _ in range(600)]
    es[7], es[90], es[200], es[201], es[300] = None, [0.0] * 8, es[100], es[100], [float("nan")] * 8
    rows = [(k % 2, k, f"s{k}", e, k) for k, e in enumerate(es)]
    df = spark.createDataFrame(rows[::-1], "bank_id int, podcast_id long, speaker string, embedding array<double>, seq long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
        out = P.clustered(df, threshold=0.8)
        assert "FlatMapGroups" not in plan(out)
        got = {r["podcast_id"]: tuple(r)[2:] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    banks = P.Bank(0.8), P.Bank(0.8)
    want = {k: banks[b].meet(None if e is None else np.asarray(e)) for b, k, _, e, _ in rows}
    assert {k: (g[0], g[2]) for k, g in got.items()} == {k: (w[0], w[2]) for k, w in want.items()}
    assert max(abs(got[k][1] - want[k][1]) for k in want) < 1e-12
    one = P.Bank(0.8)
    assert [m[0] for m in one.meet_all([None if e is None else np.asarray(e) for e in es])] == [m[0] for m in (lambda b: [b.meet(None if e is None else np.asarray(e)) for e in es])(P.Bank(0.8))]
    P_bank, alone = P.Bank(0.8), P.Bank(0.8)
    mixed = [np.asarray(e) for e in es[:5]] + [np.ones(3), np.ones(8)] + [np.asarray(e) for e in es[10:30]]
    assert [m[0] for m in P_bank.meet_all(mixed)] == [alone.meet(e)[0] for e in mixed]


def test_blocks_share_one_product(monkeypatch):
    from voxweave.operators import speakers as P

    calls = []
    own = P.Bank._multiply
    monkeypatch.setattr(P.Bank, "_multiply", lambda self, near, scores: calls.append(scores.shape) or own(self, near, scores))
    monkeypatch.setattr(P.Bank, "SMALL", 0)
    b = P.Bank(2.0)
    b.meet_all(list(np.random.default_rng(0).standard_normal((1025, 16))))
    assert len(calls) == 4 and len(b.ids) == 1025
    monkeypatch.setattr(P.Bank, "SCORES", 4000)
    b.meet_all(list(np.random.default_rng(1).standard_normal((9, 16))))
    assert all(a * n <= 4000 for a, n in calls[4:])


def test_folders_are_written_by_many_tasks(spark, tmp_path):
    """However few bytes the recordings have; a folder is written by one."""
    rows = spark.range(300).selectExpr("id % 100 AS podcast_id", "id AS seconds").coalesce(1)
    for write in (R.write_metadata, R.write_metrics):
        path = tmp_path / write.__name__
        write(rows, str(path))
        files = list(path.glob("podcast_id=*/part-*"))
        assert len(files) == 100 and len({f.name.split("-")[1] for f in files}) > 4
        assert spark.read.json(str(path)).groupBy("podcast_id").count().where("count = 3").count() == 100


def test_corrections_are_spread(spark, tmp_path):
    """The names of parts, however few their bytes, are many tasks' work."""
    spark.range(7000).selectExpr("id AS p_partkey", "concat('name ', id) AS p_name").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert Q.model_correction(spark, str(tmp_path)).rdd.getNumPartitions() == 4
    rows = Q.correction_modes(spark, str(tmp_path)).collect()
    assert len(rows) == 7000 and all(r["batched"] == r["single"] == r["spread"] == f"NAME {r['id']}" for r in rows)
