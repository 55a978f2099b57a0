"""Segments against speaker turns: overlap, purity, review, cutting.

Times are of any one numeric type (seconds, milliseconds); durations given as parameters are in the same unit.
turns: podcast_id, turn_idx, start, end, speaker. segments: podcast_id, seg_idx, start, end, speaker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "SPEAKER_00"


def overlaps(segments: DataFrame, turns: DataFrame, bucket: float | None = None) -> DataFrame:
    """Each segment with each turn of its recording that shares more than a point with it, clipped to it and counted from its start.

    An equi-join on the recording; with ``bucket``, on recording and time bucket, for recordings of very many turns: both
    sides are repeated for each bucket they touch, and a pair is kept in its first common bucket alone.
    """
    s = segments.select("podcast_id", "seg_idx", F.col("start").alias("s_start"), F.col("end").alias("s_end"))
    t = turns.select("podcast_id", "turn_idx", "speaker", F.col("start").alias("t_start"), F.col("end").alias("t_end"))
    if bucket is None:
        pairs = s.join(t, "podcast_id")
    else:
        span = lambda a, b: F.sequence(F.floor(F.col(a) / bucket), F.floor(F.col(b) / bucket))
        s = s.where("s_end >= s_start").withColumn("bucket", F.explode(span("s_start", "s_end")))
        t = t.where("t_end >= t_start").withColumn("bucket", F.explode(span("t_start", "t_end")))
        pairs = s.join(t, ["podcast_id", "bucket"]).where(F.col("bucket") == F.floor(F.greatest("s_start", "t_start") / bucket)).drop("bucket")
    a, b = F.greatest("s_start", "t_start"), F.least("s_end", "t_end")
    return pairs.where(a < b).select("podcast_id", "seg_idx", "turn_idx", "speaker", (a - F.col("s_start")).alias("start"), (b - F.col("s_start")).alias("end"), (b - a).alias("overlap"))


def by_speaker(overlap: DataFrame, amount: str = "overlap") -> DataFrame:
    """(podcast_id, seg_idx, speaker, total, first): time by speaker, and the first turn that has it."""
    return overlap.groupBy("podcast_id", "seg_idx", "speaker").agg(F.sum(amount).alias("total"), F.min("turn_idx").alias("first"))


def purity(overlap: DataFrame, amount: str = "overlap") -> DataFrame:
    """(podcast_id, seg_idx, dominant, purity, speakers, seconds): the speaker of the most time, of equals the first heard, and their share. Turns that overlap count twice."""
    best = F.max_by("speaker", F.struct(F.col("total"), (-F.col("first")).alias("f")))
    return by_speaker(overlap, amount).groupBy("podcast_id", "seg_idx").agg(best.alias("dominant"), (F.max("total") / F.sum("total")).alias("purity"), F.count("*").alias("speakers"), F.sum("total").alias("seconds"))


def assigned(segments: DataFrame, turns: DataFrame, default_length: float = 15, bucket: float | None = None) -> DataFrame:
    """Segments with the speaker of the most overlap; SPEAKER_00 where there is none. A missing end is start + default_length."""
    whole = segments.withColumn("end", F.coalesce("end", F.col("start") + default_length))
    found = purity(overlaps(whole, turns, bucket)).select("podcast_id", "seg_idx", "dominant")
    return whole.join(found, ["podcast_id", "seg_idx"], "left").withColumn("speaker", F.coalesce("dominant", F.lit(UNKNOWN))).drop("dominant")


def reviewed(segments: DataFrame, turns: DataFrame, max_speakers: int = 1, min_purity: float = 0.8, bucket: float | None = None, overlap: DataFrame | None = None) -> DataFrame:
    """Segments with decision (keep, split, drop), dominant, purity and speakers.

    Without any overlap a segment is kept as it is; with more than max_speakers it is split; below min_purity dropped; else
    kept with its dominant speaker. ``overlap`` is their overlaps, where they are known. At the default of one speaker the purity rule can't apply: a single speaker's purity is 1.
    """
    seen = purity(overlaps(segments, turns, bucket) if overlap is None else overlap).select("podcast_id", "seg_idx", "dominant", "purity", "speakers")
    joined = segments.join(seen, ["podcast_id", "seg_idx"], "left")
    decision = F.when(F.col("speakers").isNull(), "keep").when(F.col("speakers") > max_speakers, "split").when(F.col("purity") < min_purity, "drop").otherwise("keep")
    return joined.withColumn("decision", decision).withColumn("dominant", F.coalesce("dominant", F.col("speaker"))).withColumn("purity", F.coalesce("purity", F.lit(1.0))).withColumn("speakers", F.coalesce("speakers", F.lit(0)))


def split_by_speaker(segments: DataFrame, turns: DataFrame, min_length: float = 5, bucket: float | None = None, overlap: DataFrame | None = None) -> DataFrame:
    """(podcast_id, seg_idx, piece, start, end, speaker): a piece for each clipped turn of min_length or more, in absolute time; a segment without any stays whole as SPEAKER_00."""
    clipped = (overlaps(segments, turns, bucket) if overlap is None else overlap).where(F.col("overlap") >= min_length)
    base = segments.select("podcast_id", "seg_idx", F.col("start").alias("base"), F.col("end").alias("base_end"))
    order = Window.partitionBy("podcast_id", "seg_idx").orderBy("start", "turn_idx")
    pieces = clipped.join(base, ["podcast_id", "seg_idx"]).withColumn("piece", F.row_number().over(order) - 1)
    pieces = pieces.select("podcast_id", "seg_idx", "piece", (F.col("base") + F.col("start")).alias("start"), (F.col("base") + F.col("end")).alias("end"), "speaker")
    whole = base.join(clipped.select("podcast_id", "seg_idx").distinct(), ["podcast_id", "seg_idx"], "left_anti")
    return pieces.unionByName(whole.select("podcast_id", "seg_idx", F.lit(0).alias("piece"), F.col("base").alias("start"), F.col("base_end").alias("end"), F.lit(UNKNOWN).alias("speaker")))


def review(segments: DataFrame, turns: DataFrame, max_speakers: int = 1, min_purity: float = 0.8, min_length: float = 5, bucket: float | None = None) -> DataFrame:
    """The segments after review: (podcast_id, segment, start, end, speaker, speaker_purity, split_from), numbered anew in each recording. Segments below min_length go first."""
    long = segments.where(F.col("end") - F.col("start") >= min_length)
    overlap = overlaps(long, turns, bucket)  # one join: both uses below share its exchange
    seen = reviewed(long, turns, max_speakers, min_purity, overlap=overlap)
    kept = seen.where("decision = 'keep'").select("podcast_id", "seg_idx", F.lit(0).alias("piece"), "start", "end", F.col("dominant").alias("speaker"), F.col("purity").alias("speaker_purity"), F.lit(None).cast("long").alias("split_from"))
    parts = split_by_speaker(seen.where("decision = 'split'").select("podcast_id", "seg_idx", "start", "end", "speaker"), turns, min_length, overlap=overlap)
    parts = parts.select("podcast_id", "seg_idx", "piece", "start", "end", "speaker", F.lit(None).cast("double").alias("speaker_purity"), F.col("seg_idx").cast("long").alias("split_from"))
    number = F.row_number().over(Window.partitionBy("podcast_id").orderBy("seg_idx", "piece")) - 1
    return kept.unionByName(parts).withColumn("segment", number).drop("seg_idx", "piece")


def review_counts(seen: DataFrame) -> DataFrame:
    """One row a recording: segments, and how many were kept, split and dropped."""
    many = lambda d: F.count_if(F.col("decision") == d)
    return seen.groupBy("podcast_id").agg(F.count("*").alias("total"), many("keep").alias("kept"), many("split").alias("split"), many("drop").alias("dropped"))


def fixed(recordings: DataFrame, max_length: float = 15, min_length: float = 10) -> DataFrame:
    """(podcast_id, seg_idx, start, end) of recordings (podcast_id, duration): cuts of max_length; a shorter tail stays if it has min_length."""
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("duration") / max_length) - 1, F.lit(0)).cast("int")))
    cut = recordings.where("duration > 0").select("podcast_id", "duration", starts.alias("k"))
    out = cut.select("podcast_id", F.col("k").alias("seg_idx"), (F.col("k") * max_length).alias("start"), F.least((F.col("k") + 1) * max_length, F.col("duration")).alias("end"))
    return out.where(F.col("end") - F.col("start") >= min_length)


def clamped(turns: DataFrame, duration: Column) -> DataFrame:
    """Turns within the recording; those without any length go."""
    return turns.withColumn("start", F.greatest("start", F.lit(0))).withColumn("end", F.least(F.col("end"), duration)).where("end > start")


def by_turn(turns: DataFrame, duration: Column, max_length: float = 15, min_length: float = 10) -> DataFrame:
    """Segments from turns: clamped, short ones dropped, long ones cut at max_length, pieces below min_length skipped. (With the sound at hand, ``signal.split_turns`` cuts at the quietest place near max_length.)"""
    kept = clamped(turns, duration).where(F.col("end") - F.col("start") >= min_length)
    pieces = F.sequence(F.lit(0), (F.ceil((F.col("end") - F.col("start")) / max_length) - 1).cast("int"))
    cut = kept.withColumn("k", F.explode(pieces))
    cut = cut.select("podcast_id", "turn_idx", "speaker", "k", (F.col("start") + F.col("k") * max_length).alias("start"), F.least(F.col("start") + (F.col("k") + 1) * max_length, F.col("end")).alias("end")).where(F.col("end") - F.col("start") >= min_length)
    number = F.row_number().over(Window.partitionBy("podcast_id").orderBy("start", "turn_idx", "k")) - 1
    return cut.withColumn("seg_idx", number).select("podcast_id", "seg_idx", "start", "end", "speaker")


def rebased(parts: DataFrame) -> DataFrame:
    """(podcast_id, seg_idx, start, end) of (podcast_id, seg_idx, duration): kept time, each part where the one before ends."""
    before = Window.partitionBy("podcast_id").orderBy("seg_idx").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("duration").over(before), F.lit(0))
    return parts.withColumn("start", start).withColumn("end", F.col("start") + F.col("duration"))


def filled(chunks: DataFrame, max_length: float = 15, min_length: float = 10) -> DataFrame:
    """(podcast_id, seg_idx, duration): chunks between silences (podcast_id, chunk_idx, duration) put together in order.

    A chunk that would make the segment longer than max_length ends it: it is kept if it has min_length, else discarded. A segment of
    0.9 max_length ends at once. What is left at the end is cut to pieces of max_length if longer, and pieces below min_length are dropped.
    A fold in order of chunks within each recording, in the JVM.
    """
    state = "struct<open:double,done:array<double>>"
    ordered = chunks.groupBy("podcast_id").agg(F.array_sort(F.collect_list(F.struct("chunk_idx", F.col("duration").cast("double").alias("d")))).alias("c"))
    empty = F.struct(F.lit(0.0).alias("open"), F.array().cast("array<double>").alias("done")).cast(state)

    def step(a: Column, x: Column) -> Column:
        d = x["d"]
        over = (a["open"] > 0) & (a["open"] + d > max_length)
        done = F.when(over & (a["open"] >= min_length), F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"])
        now = F.when(over, d).otherwise(a["open"] + d)
        full = (now >= min_length) & (now >= 0.9 * max_length)
        return F.struct(F.when(full, F.lit(0.0)).otherwise(now).alias("open"), F.when(full, F.concat(done, F.array(now))).otherwise(done).alias("done")).cast(state)

    def end(a: Column) -> Column:
        tail = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(a["open"] / max_length).cast("int") - 1, F.lit(0))), lambda k: F.least(F.lit(float(max_length)), a["open"] - k * max_length))
        return F.concat(a["done"], F.filter(tail, lambda d: (d >= min_length) & (d > 0)))

    folded = ordered.select("podcast_id", F.posexplode(F.aggregate("c", empty, step, end)).alias("seg_idx", "duration"))
    return folded


def transcribed_again(reviewed_rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Reviewed rows (podcast_id, segment, split_from, text, ...) of which those that were split take the text and language of their new transcript (podcast_id, segment, text, language); others, and those without one, keep theirs."""
    again = texts.select("podcast_id", "segment", F.col("text").alias("__text"), F.col("language").alias("__language"))
    joined = reviewed_rows.join(again, ["podcast_id", "segment"], "left")
    new = F.col("split_from").isNotNull() & F.col("__text").isNotNull()
    return joined.withColumn("text", F.when(new, F.col("__text")).otherwise(F.col("text"))).withColumn("language", F.when(new, F.col("__language")).otherwise(F.col("language"))).drop("__text", "__language")
