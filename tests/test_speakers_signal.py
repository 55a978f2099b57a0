import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxweave.functions import vectors as V
from voxweave.operators import signal as S
from voxweave.operators import speakers as P
from voxweave.sources import tables as R


def test_bank_golden():
    b = P.Bank(0.8)
    assert b.add(np.array([1.0, 0, 0])) == "SPEAKER_GLOBAL_001"
    name, score = b.match(np.array([0.9, 0.1, 0]))
    assert name == "SPEAKER_GLOBAL_001" and score == pytest.approx(0.99388, abs=1e-5)
    b.update(name, np.array([0.9, 0.1, 0]))
    assert b.times == [2] and np.linalg.norm(b.vectors[0]) == pytest.approx(1)
    assert b.add(np.array([0.0, 1, 0])) == "SPEAKER_GLOBAL_002"
    assert b.match(np.array([0.0, 0, 1]))[0] is None
    assert b.add(np.array([np.nan, 1])) is None and b.add(np.zeros(3)) is None and b.match(None) == (None, 0.0)


def test_ids():
    assert P.next_id(["SPEAKER_GLOBAL_999"]) == "SPEAKER_GLOBAL_1000"
    assert P.next_id(["SPEAKER_GLOBAL_1000", "SPEAKER_GLOBAL_999"]) == "SPEAKER_GLOBAL_1001"
    assert P.next_id(["a"], lambda n: f"own{n}") == "own2"


def test_clustering_is_the_plain_fold(spark):
    rng = np.random.default_rng(1)
    rows = [(k // 2, f"S{k % 2}", rng.normal(size=4).tolist() if k != 7 else None, k) for k in range(40)]
    df = spark.createDataFrame(rows, "podcast_id long, speaker string, embedding array<double>, seq long")
    got = {(r["podcast_id"], r["speaker"]): r["global_id"] for r in P.clustered(df.repartition(5), threshold=0.6).collect()}
    b = P.Bank(0.6)
    assert got == {(p, s): b.meet(None if e is None else np.array(e))[0] for p, s, e, _ in rows}
    assert P.clustered(df.limit(0)).count() == 0


def test_nearest(spark):
    bank = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 2.0])], "speaker_id string, embedding array<double>")
    q = spark.createDataFrame([(1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None)], "query_id long, embedding array<double>")
    got = {r["query_id"]: (r["speaker_id"], round(r["score"], 4)) for r in P.nearest(q, bank, 0.9).collect()}
    assert got == {1: ("a", 1.0), 2: (None, 0.7071), 3: (None, 0.0), 4: (None, 0.0)}
    assert {r["speaker_id"] for r in P.nearest(q, bank.limit(0)).collect()} == {None}


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([float("nan"), 2.0],), ([0.0, 0.0],), ([],), (None,)], "e array<double>")
    got = df.select(V.unit(F.col("e")).alias("u"), V.valid(F.col("e")).alias("v"), V.cosine(F.col("e"), F.col("e")).alias("c")).collect()
    assert [r["v"] for r in got] == [True, False, False, False, False]
    assert got[0]["u"] == [0.6, 0.8] and got[1]["u"] == [0.0, 1.0] and got[4]["c"] == -1 and got[1]["c"] == -1


def tone(seconds, rate=8000, level=0.5):
    return level * np.sin(np.arange(int(seconds * rate)) * 2 * np.pi * 220 / rate)


def test_audio(spark, tmp_path):
    rate = 8000
    x = np.concatenate([tone(3), np.zeros(rate), tone(2), np.zeros(rate // 4), tone(1)])
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.wav").write_bytes(S.encode_wav(x, rate))
    (tmp_path / "sub" / "b.wav").write_bytes(b"not sound")
    (tmp_path / "c.txt").write_bytes(b"x")
    files = R.recordings(spark, str(tmp_path))
    assert files.count() == 2
    probe = {r["path"][-5:]: r for r in R.probed(files).collect()}
    assert probe["a.wav"]["seconds"] == pytest.approx(7.25) and probe["b.wav"]["corrupt"]
    normal = {r["path"][-5:]: r for r in S.normalised_files(files).collect()}
    assert normal["a.wav"]["loudness"] == pytest.approx(-23, abs=0.1) and normal["a.wav"]["sample_rate"] == 22050
    assert normal["b.wav"]["error"] and normal["b.wav"]["content"] is None
    good = files.where("path like '%a.wav'")
    parts = [round(r["duration"], 1) for r in S.segmented_files(good).orderBy("chunk_idx").collect()]
    assert parts == [3.2, 3.5]
    seg = spark.createDataFrame([("r", 0, 0.0, 1.5)], "podcast_id string, seg_idx long, start double, end double")
    cut = S.cut_files(seg, good.select(F.lit("r").alias("podcast_id"), "content")).first()
    assert len(S.decode_wav(cut["content"])[0]) == 1.5 * rate
    said = S.transcribed(files, lambda content: {"text": "hola", "language": "es"} if content[:4] == b"RIFF" else 1 / 0)
    assert {r["text"] for r in said.collect()} == {"hola", ""}
    assert {r["ok"] for r in R.repaired(files).collect()} == {True, False}


def test_cuts():
    rate = 1000
    x = np.ones(40 * rate)
    x[14300:14400] = 0
    cut = S.best_cut(x, rate, 0, 15, 10, 40)
    assert 14.3 <= cut <= 14.4
    pieces = S.split_long(x, rate, 0, 40, 15, 10)
    assert pieces[0] == (0, cut) and all(10 <= z - a <= 16 for a, z in pieces)
    for width in (1, 2, 4):
        assert S.resample(np.arange(10.0), 10, 10 * width).shape == (10 * width,)
    assert S.quiet_parts(np.zeros(100), 100) == []


def test_tables(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert R.registry(spark, path).count() == 0
    one = spark.createDataFrame([("v1", "processed")], "video_id string, status string")
    R.replace(one, path)
    R.replace(R.registry(spark, path).where("status = 'processed'"), path)
    assert R.registry(spark, path).count() == 1
    assert R.config(spark, str(tmp_path / "none.json")) == {} and R.glossary(spark, str(tmp_path / "none.json")) == []
    (tmp_path / "g.json").write_text('{"correcciones": {"b": "B", "a": "A"}}')
    assert R.glossary(spark, str(tmp_path / "g.json")) == [("b", "B"), ("a", "A")]
    R.write_metadata(spark.createDataFrame([("p", "hola")], "podcast_id string, text string"), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 1


def test_formats(spark):
    rate, x = 1000, tone(1, 1000)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(3)
        w.setframerate(rate)
        v = np.round(np.repeat(x, 2) * (2**23 - 1)).astype(np.int32)
        w.writeframes(b"".join(int(i).to_bytes(3, "little", signed=True) for i in v))
    got, own = S.decode(out.getvalue())
    assert own == rate and np.allclose(got, x, atol=1e-6)
    rows = [("a", S.encode_wav(x, rate)), ("b", b"ID3" + bytes(50)), ("c", b"what"), ("d", None), ("e", S.encode_wav(np.tile(x, 8), rate)[:-5001])]
    df = spark.createDataFrame(rows, "path string, content binary")
    probe = {r["path"]: (r["format"], r["readable"], r["corrupt"]) for r in R.probed(df).collect()}
    assert probe["a"] == ("wav", True, False) and probe["b"] == ("mp3", False, False) and probe["c"] == (None, False, True) and probe["d"] == (None, False, True)
    mp3 = {"mp3": lambda content: (np.ones(500), 500)}
    assert {r["path"]: r["seconds"] for r in R.probed(df, mp3).collect()}["b"] == 1
    assert {r["path"]: r["error"] is None for r in S.converted_files(df, decoders=mp3).collect()} == {"a": True, "b": True, "c": False, "d": False, "e": False}
    parts = S.segmented_files(df).collect()
    assert {r["path" if "path" in r.asDict() else "podcast_id"] for r in parts if r["error"]} == {"b", "c", "d", "e"} and any(r["duration"] for r in parts)
    seg = spark.createDataFrame([(p, 0, 0.0, 0.5) for p in "abz"], "podcast_id string, seg_idx long, start double, end double")
    cut = {r["podcast_id"]: r["error"] for r in S.cut_files(seg, df.withColumnRenamed("path", "podcast_id")).collect()}
    assert cut["a"] is None and cut["b"] and cut["z"]
    report = {r["path"]: (r["valid"], r["message"], r["repaired"]) for r in R.validated_files(df).collect()}
    assert report["a"] == (True, "ok", None) and report["d"][1] == "too small" and report["b"][1] == "too small" and not report["c"][2]
    assert report["e"] == (False, "unreadable", True)  # ends within a sample: read as far as it goes


def test_repair_reads_what_is_there():
    good = S.encode_wav(tone(2, 1000), 1000)
    broken = good[:4] + b"\xff\xff\xff\xff" + good[8:16] + b"\x00\x00\x00\x00" + good[20:]
    x, rate = R.salvaged(broken)
    assert rate == 1000 and len(x) == 2000


def test_replacing_is_safe(spark, tmp_path):
    """A replacement that is broken off after any of its steps leaves the old table or the new one."""
    import shutil

    path = str(tmp_path / "t")
    R.replace(spark.createDataFrame([("v1",)], "video_id string"), path)
    shutil.move(path, f"{path}.old")  # renamed aside, and then nothing more
    assert [r["video_id"] for r in R.registry(spark, path).collect()] == ["v1"]
    R.replace(spark.createDataFrame([("v2",)], "video_id string"), path)
    assert [r["video_id"] for r in R.registry(spark, path).collect()] == ["v2"]
    (tmp_path / "t.old").mkdir()
    R.replace(R.registry(spark, path), path)
    assert R.registry(spark, path).count() == 1 and not (tmp_path / "t.old").exists()


def test_bank_grows_and_mixes():
    rng, b, plain = np.random.default_rng(3), P.Bank(0.7), []
    for _ in range(200):
        e = rng.normal(size=3)
        u = e / np.linalg.norm(e)
        scores = [v @ u for v, _ in plain]
        if plain and max(scores) >= 0.7:
            k = int(np.argmax(scores))
            v, n = plain[k]
            v = (v * n + u) / (n + 1)
            plain[k] = (v / np.linalg.norm(v), n + 1)
        else:
            plain.append((u, 1))
        b.meet(e)
    assert len(b.ids) == len(plain) and np.allclose(b.vectors, [v for v, _ in plain]) and b.times == [n for _, n in plain]
    b.add(np.ones(5))
    assert b.match(np.ones(5)) == (None, 0.0) and len(b.vectors) == len(b.ids)


def test_nearest_in_blocks(spark):
    rng = np.random.default_rng(4)
    bank = [(f"s{k:02}", rng.normal(size=4).tolist()) for k in range(40)] + [("s99", [1.0, 2.0])]
    qs = [(k, rng.normal(size=4).tolist()) for k in range(30)] + [(30, [3.0, 6.0]), (31, [1.0])]
    b, q = spark.createDataFrame(bank, "speaker_id string, embedding array<double>"), spark.createDataFrame(qs, "query_id long, embedding array<double>")
    one = {r["query_id"]: (r["speaker_id"], round(r["score"], 9)) for r in P.nearest(q, b, 0.5).collect()}
    assert one == {r["query_id"]: (r["speaker_id"], round(r["score"], 9)) for r in P.nearest(q, b, 0.5, bank_bytes=500).collect()}
    assert one[30] == ("s99", 1.0) and one[31] == (None, -1.0)
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    for k, v in qs[:30]:
        score, name = max((float(unit(v) @ unit(e)), i) for i, e in bank[:40])
        assert one[k] == (name if score >= 0.5 else None, round(score, 9))
