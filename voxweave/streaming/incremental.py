"""Structured Streaming forms: resume through the registry, and the online speaker fold."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.catalog import first_of_each, unseen
from ..operators.speakers import THRESHOLD, Bank
from ..sources.tables import log, logged


def processed_once(stream: DataFrame, registry_path: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], key: str = "id", number: int = 0) -> StreamingQuery:
    """Each micro-batch's new rows, once each, go through ``work``, which gives (video_id, status, stage, ...) rows for the registry's log. A batch writes its own folder of the log and nothing else; run again after a failure, it replaces what it wrote. ``tables.logged`` reads the registry, ``tables.compacted`` makes one folder of many. A stream with another checkpoint needs another ``number`` (up to 2^20), which keeps its folders apart."""

    def batch(df: DataFrame, n: int) -> None:
        at = (number << 40) + n
        known = logged(df.sparkSession, registry_path, before=at)
        new = first_of_each(unseen(df, known), key, key)
        log(work(new), registry_path, at)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def clustered_stream(stream: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(podcast_id, speaker, global_id, score, created) of a stream (bank_id, podcast_id, speaker, embedding, seq): each bank is the state of its key, so it outlives batches and restarts. Within a batch rows are met in order of seq."""

    def meet(key: tuple, pdfs, state: GroupState):
        bank = Bank(threshold)
        if state.exists:
            ids, vectors, times = state.get
            for name, v, n in zip(ids, np.asarray(vectors).reshape(len(ids), -1) if len(ids) else [], times):
                bank.load(name, v, n)
        rows = pd.concat(list(pdfs)).sort_values("seq", kind="stable")
        met = bank.meet_all([None if e is None else np.asarray(e, np.float64) for e in rows["embedding"]])
        state.update((bank.ids, [float(x) for v in bank.vectors for x in v], bank.times))
        yield pd.DataFrame({"podcast_id": rows["podcast_id"].astype(str).to_numpy(), "speaker": rows["speaker"].to_numpy(), "global_id": [m[0] for m in met], "score": [m[1] for m in met], "created": [m[2] for m in met]})

    return stream.groupBy("bank_id").applyInPandasWithState(meet, "podcast_id string, speaker string, global_id string, score double, created boolean", "ids array<string>, vectors array<double>, times array<int>", "append", GroupStateTimeout.NoTimeout)


def energy_stream(samples: DataFrame, width: str = "2 seconds", late: str = "10 seconds") -> DataFrame:
    """(podcast_id, start, end, energy) of a stream (podcast_id, ts, x): mean square by tumbling window; windows close when the watermark has passed them."""
    grouped = samples.withWatermark("ts", late).groupBy("podcast_id", F.window("ts", width))
    return grouped.agg(F.avg(F.col("x") * F.col("x")).alias("energy")).select("podcast_id", F.col("window.start").alias("start"), F.col("window.end").alias("end"), "energy")
