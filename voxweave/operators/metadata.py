"""The product: one row a segment. Joins by ordinal, clean-up, constraints and figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank, clean_id, speaker_code, speaker_number, strip


def with_transcripts(segments: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Segments with text and language of the transcript of the same ordinal; without one, blank and 'unknown'."""
    t = transcripts.select("podcast_id", "seg_idx", "text", "language")
    return segments.join(t, ["podcast_id", "seg_idx"], "left").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("language", F.coalesce("language", F.lit("unknown")))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with segment_id seg_nnnn, from 0 in each recording."""
    return rows.withColumn("segment_id", F.format_string("seg_%04d", F.row_number().over(Window.partitionBy("podcast_id").orderBy(*order)) - 1))


def metadata(rows: DataFrame) -> DataFrame:
    """The ten columns, of rows (podcast_id, seg_idx, path, start, end, speaker, text, language); rows of blank text go after numbering."""
    out = numbered(rows, "seg_idx").where(~blank(F.col("text")))
    return out.select("text", "path", speaker_number(F.col("speaker")).alias("speaker"), F.col("speaker").alias("speaker_label"), "start", "end", (F.col("end") - F.col("start")).alias("duration"), "language", clean_id(F.col("podcast_id")).alias("podcast_id"), "segment_id")


def cleaned(rows: DataFrame, present: Column) -> DataFrame:
    """rows (podcast_id, pos, path, speaker_label) that remain: a file that is present, and a speaker, if need be from the file's name. Ids keep the number a row had before, so they have gaps."""
    stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    named = F.nullif(F.regexp_extract(stem, r"(?:SPK_|SPEAKER_GLOBAL_|SPEAKER_(?=[0-9]))([0-9]+)", 1), F.lit(""))
    unknown = F.coalesce(F.col("speaker_label"), F.lit("")).isin("", "SPEAKER_00")
    label = F.when(unknown, F.when(named.isNotNull(), F.format_string("SPK_%02d", named.cast("int")))).otherwise(F.col("speaker_label"))
    kept = rows.withColumn("i", F.row_number().over(Window.partitionBy("podcast_id").orderBy("pos")) - 1).withColumn("speaker_label", label).where(present & F.col("speaker_label").isNotNull())
    code = speaker_code(F.col("speaker_label"))
    return kept.withColumn("speaker_label", code).withColumn("segment_id", F.format_string("seg_%04d_%s", "i", code)).withColumn("new_path", F.concat("segment_id", F.lit(".wav"))).drop("i")


def cleanup_counts(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """(podcast_id, kept, removed, renamed)."""
    after = kept.groupBy("podcast_id").agg(F.count("*").alias("kept"), F.count_if(F.col("path") != F.col("new_path")).alias("renamed"))
    before = rows.groupBy("podcast_id").agg(F.count("*").alias("__n"))
    return before.join(after, "podcast_id", "left").select("podcast_id", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("__n") - F.coalesce("kept", F.lit(0))).alias("removed"), F.coalesce("renamed", F.lit(0)).alias("renamed"))


def speaker_figures(rows: DataFrame) -> DataFrame:
    """(podcast_id, speaker, segments, seconds)."""
    return rows.groupBy("podcast_id", "speaker").agg(F.count("*").alias("segments"), F.round(F.sum("duration"), 2).alias("seconds"))


def speaker_map(rows: DataFrame) -> DataFrame:
    """(podcast_id, speakers): a map of speaker to figures."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("speaker", F.struct("segments", "seconds").alias("figures")))))
    return speaker_figures(rows).groupBy("podcast_id").agg(entries.alias("speakers"))


def efficiency(useful: Column, total: Column) -> Column:
    """Per cent, 0 where there is no total."""
    return F.coalesce(F.round(F.try_divide(useful * 100.0, total), 2), F.lit(0.0))


Rule = tuple[str, Column]


def validated(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """rows with errors (names of the rules that don't hold; a null doesn't break a rule) and is_valid."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules]))
    return rows.withColumn("errors", broken).withColumn("is_valid", F.size("errors") == 0)


def segment_rules() -> list[Rule]:
    c = F.col
    return [("text_present", F.length(strip(F.coalesce(c("text"), F.lit("")))) > 0), ("duration_positive", F.coalesce(c("duration"), F.lit(0)) > 0), ("start_not_negative", c("start") >= 0), ("end_not_negative", c("end") >= 0), ("end_after_start", c("end") > c("start"))]


def correction_rules() -> list[Rule]:
    c = F.col
    return [("text_present", F.length(strip(F.coalesce(c("corrected"), F.lit("")))) > 0), ("at_most_10_changes", F.size("changes") <= 10), ("confidence_in_range", c("confidence").between(0, 1))]


def request_rules(most: int = 10) -> list[Rule]:
    """Of requests (texts, ids): one to ``most`` texts, none blank, and an id for each where there are ids."""
    c = F.col
    return [("texts_present", F.size("texts") >= 1), (f"at_most_{most}_texts", F.size("texts") <= most), ("no_blank_text", ~F.exists("texts", lambda t: F.length(strip(F.coalesce(t, F.lit("")))) == 0)), ("an_id_for_each", c("ids").isNull() | (F.size("ids") == F.size("texts")))]


def stats_rules() -> list[Rule]:
    """Of a recording's figures (segments, speakers, useful, total, efficiency)."""
    c = F.col
    return [("counts_not_negative", (c("segments") >= 0) & (c("speakers") >= 0)), ("times_not_negative", (c("useful") >= 0) & (c("total") >= 0)), ("efficiency_in_range", c("efficiency").between(0, 100))]


def with_efficiency(rows: DataFrame) -> DataFrame:
    """Figures whose efficiency is missing or 0 get it from useful and total."""
    return rows.withColumn("efficiency", F.when(F.coalesce("efficiency", F.lit(0.0)) == 0, efficiency(F.col("useful"), F.col("total"))).otherwise(F.round("efficiency", 2)))


def rounded(rows: DataFrame) -> DataFrame:
    """Times to 3 places, as the contract keeps them."""
    return rows.withColumns({c: F.round(c, 3) for c in ("start", "end", "duration") if c in rows.columns})


def tidy_changes(c: Column) -> Column:
    """Changes without blanks at their ends, blank ones left out."""
    return F.filter(F.transform(c, strip), lambda x: x != "")


def metrics(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """One nested row a recording: segments, speakers, seconds, and the review's counts (podcast_id, total, kept, split, dropped)."""
    own = rows.groupBy("podcast_id").agg(F.count("*").alias("segments"), F.countDistinct("speaker").alias("speakers"), F.sum("duration").alias("seconds"))
    return own.join(seen, "podcast_id", "left").select("podcast_id", F.struct("segments", "speakers", "seconds").alias("result"), F.struct("total", "kept", "split", "dropped").alias("review"))


def combined(parts: list[DataFrame]) -> DataFrame:
    """Metadata of several recordings in one."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
