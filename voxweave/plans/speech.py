"""Whole plans: recording to metadata, search to selection, texts to corrected texts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cache as C
from ..operators import catalog as L
from ..operators import correction as K
from ..operators import intervals as I
from ..operators import metadata as M


def recording_to_metadata(turns: DataFrame, durations: DataFrame, transcripts: DataFrame, rules: list[tuple[str, str]], max_length: float = 15, min_length: float = 10, max_speakers: int = 1, min_purity: float = 0.8, min_review: float = 5) -> DataFrame:
    """turns -> segments -> review -> transcripts by ordinal -> text repair -> metadata; shuffles on podcast_id alone."""
    joined = turns.join(durations, "podcast_id")
    segments = I.by_turn(joined, F.col("duration"), max_length, min_length)
    good = I.review(segments, turns, max_speakers, min_purity, min_review).withColumnRenamed("segment", "seg_idx")
    worded = M.with_transcripts(good, transcripts)
    repaired = T.preprocessed(worded, "text", rules)
    return M.metadata(repaired.withColumn("path", F.format_string("seg_%04d.wav", "seg_idx")))


def corrected_texts(texts: DataFrame, cache: DataFrame, client: K.Client, least: float = K.CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(texts (id, text) with what is in force, new cache entries): cached texts aren't sent; each distinct text is sent once."""
    looked = C.looked_up(texts, cache)
    work = looked.where("not hit").groupBy("text_hash").agg(F.min(F.struct("id", "text")).alias("s")).select("text_hash", "s.id", "s.text")
    answers = K.corrected(work, client)
    fresh = work.select("text_hash", "id").join(answers, "id").select("text_hash", "corrected", "changes", "confidence", "error")
    old = looked.select("id", "text", "text_hash", "hit", F.col("cached.text").alias("c_text"), F.col("cached.changes").alias("c_changes"), F.col("cached.confidence").alias("c_confidence"))
    both = old.join(fresh, "text_hash", "left").select("id", "text", "hit", F.when(F.col("hit"), F.col("c_text")).otherwise(F.coalesce("corrected", "text")).alias("corrected"), F.when(F.col("hit"), F.col("c_changes")).otherwise(F.col("changes")).alias("changes"), F.when(F.col("hit"), F.col("c_confidence")).otherwise(F.col("confidence")).alias("confidence"), F.when(~F.col("hit"), F.col("error")).alias("error"))
    return K.gated(both, least), fresh.where("error is null").select("text_hash", F.col("corrected").alias("text"), "changes", "confidence")


@dataclass(frozen=True)
class Ready:
    """Which steps of a run can be done with what is at hand, and why the others can't."""

    diarize: str  # model or energy
    bank: bool
    review: bool
    transcribe: bool
    correct: bool
    reasons: tuple[str, ...]


def readiness(diarizer: object | None = None, embedder: object | None = None, bank: bool = False, transcriber: object | None = None, client: K.Client | None = None, global_turns: bool = False, embedder_needs_key: bool = False, key: str | None = None) -> Ready:
    """Settled before a plan is built: the bank needs a model of embeddings, and that its key where it asks for one; review needs turns of the whole recording or a diarizer; correction needs a model that answers."""
    why = []
    can_bank = bank and embedder is not None and not (embedder_needs_key and not key)
    if bank and embedder is None:
        why.append("bank: no model of embeddings")
    elif bank and not can_bank:
        why.append("bank: the model of embeddings needs a key")
    review = global_turns or diarizer is not None
    if not review:
        why.append("review: neither turns of the recording nor a diarizer")
    correct = client is not None and K.healthy(client)
    if client is not None and not correct:
        why.append("correct: the model doesn't answer")
    return Ready("model" if diarizer else "energy", can_bank, review, transcriber is not None, correct, tuple(why))


def run(found: DataFrame, registry: DataFrame, fetch: Callable[[str], bytes], work: Callable[[DataFrame], DataFrame], quota: int, keywords: list[str], channels: list[str], tries: int = 3) -> tuple[DataFrame, DataFrame]:
    """(details, changes): search results through selection, download and ``work``, which gives (id, segments, audio_seconds, processing_seconds, error) of what was downloaded (id, content). details are rows for ``catalog.run_summary``; changes are rows for the registry, failed ones with the stage they failed at."""
    chosen = L.selection(found, registry, quota, keywords, channels)
    got = L.downloaded(chosen.select("id", "url"), fetch, tries)
    done = work(got.where("ok").select("id", "content"))
    rows = chosen.select("id", "title", "category").join(got.drop("content", "url"), "id").join(done.withColumnRenamed("error", "work_error"), "id", "left")
    status = F.when(~F.col("ok") | F.col("work_error").isNotNull() | F.col("segments").isNull(), "failed").otherwise("processed")
    details = rows.select("id", "title", "category", status.alias("status"), F.when(~F.col("ok"), "download").when(status == "failed", "processing").otherwise("completed").alias("stage"), F.coalesce("error", "work_error").alias("error"), "segments", "audio_seconds", "processing_seconds")
    changes = details.select(F.col("id").alias("video_id"), "status", "title", "stage", "category", "error", F.col("segments").cast("long").alias("segments"), F.current_timestamp().alias("timestamp"))
    return details, changes
