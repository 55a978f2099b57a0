import json

import numpy as np
from pyspark.sql import functions as F

from voxweave.operators import correction as K
from voxweave.operators import speakers as P
from voxweave.sources import tables as R
from voxweave.streaming import incremental as N


def test_repair():
    cases = ['```json\n{"correcciones": [{"id": 0, "texto_corregido": "a", "cambios": [],}]}\n```', 'Here is it: {"correcciones": [{"id": 0 "texto_corregido": "a"}]} bye', '{"correcciones": [{"id": 0, "texto_corregido": "a"} {"id": 1, "texto_corregido": "b"}]}', '{"correcciones": [{"id": 0, // x\n "texto_corregido": "a"\n "cambios": []}]}']
    for c in cases:
        assert json.loads(K.repaired_json(c))["correcciones"][0]["texto_corregido"] == "a"


def test_batches_fail_one_by_one(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["uno", "dos", "bad", "", None, "seis"])], "id long, text string")

    def client(system, prompt):
        if "bad" in prompt:
            raise RuntimeError("down")
        return json.dumps({"correcciones": [{"id": 0, "texto_corregido": "X", "cambios": [" c ", ""], "confianza": 7}, {"id": 0, "texto_corregido": "Y"}]})

    got = {r["id"]: (r["corrected"], r["error"], r["confidence"]) for r in K.corrected(df.coalesce(1), client).collect()}
    assert got == {0: ("X", None, 1.0), 1: ("X", None, 1.0), 2: ("bad", "failed", 0.0), 3: ("", "empty", 0.0), 4: (None, "empty", 0.0), 5: ("X", None, 1.0)}


def test_single_answers(spark):
    rows = [('{"texto_corregido": "a", "confianza": 3}', True, "a", 1.0), ("x", False, "o", 0.0), ('{"texto_corregido": "b"', True, "b", 0.5), ("", False, "o", 0.0), (None, False, "o", 0.0)]
    df = spark.createDataFrame([(r[0],) for r in rows], "a string").select(K.parsed(F.col("a"), F.lit("o")).alias("r")).select("r.*")
    assert [(r["success"] or False, r["text"], r["confidence"]) for r in df.collect()] == [r[1:] for r in rows]


def test_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(0, str(k), "S", rng.normal(size=3).tolist(), k) for k in range(30)]
    schema = "bank_id long, podcast_id string, speaker string, embedding array<double>, seq long"
    for k in range(3):
        spark.createDataFrame(rows[k * 10 : k * 10 + 10], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    batch = {r["podcast_id"]: r["global_id"] for r in P.clustered(spark.createDataFrame(rows, schema), threshold=0.7).collect()}
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = N.clustered_stream(stream, 0.7).writeStream.format("memory").queryName("met").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r["podcast_id"]: r["global_id"] for r in spark.table("met").collect()} == batch


def test_resume(spark, tmp_path):
    def put(ids):
        spark.createDataFrame([(i,) for i in ids], "id string").write.mode("append").parquet(str(tmp_path / "in"))

    def work(df):
        return df.select(F.col("id").alias("video_id"), F.lit("processed").alias("status"), F.current_timestamp().alias("timestamp"))

    for ids, n in ((["a", "b", "a"], 2), (["b", "c"], 3)):
        put(ids)
        stream = spark.readStream.schema("id string").parquet(str(tmp_path / "in"))
        N.processed_once(stream, str(tmp_path / "reg"), str(tmp_path / "cp"), work).awaitTermination(120)
        assert R.registry(spark, str(tmp_path / "reg")).count() == n


def test_energy_stream(spark, tmp_path):
    spark.range(40).select(F.lit("p").alias("podcast_id"), F.timestamp_micros(F.col("id") * 500_000).alias("ts"), (F.col("id") % 4).cast("double").alias("x")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("podcast_id string, ts timestamp, x double").parquet(str(tmp_path / "in"))
    q = N.energy_stream(stream, late="1 second").writeStream.format("memory").queryName("energy").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r["energy"] for r in spark.table("energy").collect()} == {3.5}
