"""Sources and sinks: audio files, JSON configuration, registries, caches, banks, metadata."""

from __future__ import annotations

import atexit
import io
import json
import shutil
import tempfile
import wave
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import cache as C
from ..operators import catalog as L
from ..operators import glossary as G
from ..operators import signal as S
from ..operators.spread import in_batches

AUDIO = ("wav", "mp3", "flac", "m4a", "ogg")
REGISTRY = "video_id string, status string, title string, stage string, audio_path string, error string, segments long, category string, timestamp timestamp, retried boolean"
CACHE = "text_hash string, text string, changes array<string>, confidence double, model string, created_at timestamp, hits long, last_accessed timestamp"
BANK = "speaker_id string, embedding array<float>, occurrences int, last_seen timestamp"


def config(spark: SparkSession, path: str) -> dict:
    """A JSON object; {} where there is no file. Small, and needed before plans are built, so read by the driver, from any file system."""
    at, fs = _path(spark, path)
    rows = spark.read.text(path, wholetext=True).collect() if fs.exists(at) else []
    return json.loads(rows[0][0]) if rows else {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it; where it is unset, in local mode alone, one of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at:
        return at
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def recordings(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length, content) of audio files below a folder, each once, or of one file. Columns that aren't used aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(AUDIO) + "}").load(path)


def probed(files: DataFrame, decoders: S.Decoders | None = None) -> DataFrame:
    """(path, length, format, readable, seconds, corrupt, reason): what can be told of each file by decoding it. A known format without a decoder is neither readable nor corrupt."""

    return _probes(files, decoders).drop("content")


def _probes(files: DataFrame, decoders: S.Decoders | None = None) -> DataFrame:
    """``probed`` with the content."""

    def one(path: str, content: bytes | None) -> tuple:
        size, kind = 0 if content is None else len(content), S.audio_format(content)
        try:
            x, rate = S.decode(content, decoders)
            return path, size, kind, True, len(x) / rate, False, None, content
        except Exception as e:  # noqa: BLE001 - any failure to decode is what is asked for
            return path, size, kind, False, None, not isinstance(e, S.UnsupportedError), str(e) or type(e).__name__, content

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from in_batches(map(one, pdf["path"], pdf["content"]), ["path", "length", "format", "readable", "seconds", "corrupt", "reason", "content"])

    return files.select("path", "content").mapInPandas(run, "path string, length long, format string, readable boolean, seconds double, corrupt boolean, reason string, content binary")


def salvaged(content: bytes, decoders: S.Decoders | None = None) -> S.Sound:
    """Samples of a file as far as it goes: one whose header promises more than there is, or is broken behind the format, is read by what is there."""
    try:
        return S.decode(content, decoders)
    except S.UnsupportedError:
        raise
    except Exception:
        form, data = content.find(b"fmt "), content.find(b"data")
        if S.audio_format(content) != "wav" or form < 0 or data < 0:
            raise
        channels, rate = int.from_bytes(content[form + 10 : form + 12], "little"), int.from_bytes(content[form + 12 : form + 16], "little")
        bits = int.from_bytes(content[form + 22 : form + 24], "little")
        width = max(1, channels) * bits // 8
        body = content[data + 8 :]
        body = body[: len(body) // width * width] if width else b""
        if bits not in (8, 16, 24, 32) or not rate or not body:
            raise
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(max(1, channels))
            w.setsampwidth(bits // 8)
            w.setframerate(rate)
            w.writeframes(body)
        return S.decode_wav(out.getvalue())


def repaired(files: DataFrame, rate: int = 16_000, least: int = 10_000, decoders: S.Decoders | None = None) -> DataFrame:
    """(path, content, ok): files decoded as far as they go and written anew, mono, at ``rate``; ok if more than ``least`` bytes result that can be read again."""

    one = _repairer(rate, least, decoders)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from in_batches(((path, *one(content)) for path, content in zip(pdf["path"], pdf["content"])), ["path", "content", "ok"])

    return files.select("path", "content").mapInPandas(run, "path string, content binary, ok boolean")


def _repairer(rate: int = 16_000, least: int = 10_000, decoders: S.Decoders | None = None) -> Callable[[bytes | None], tuple[bytes | None, bool]]:
    """``repaired`` for one file: (content, ok)."""

    def one(content: bytes | None) -> tuple[bytes | None, bool]:
        try:
            x, own = salvaged(content, decoders)
            new = S.encode_wav(S.resample(x, own, rate), rate)
            return new, len(new) > least and len(S.decode_wav(new)[0]) > 0
        except Exception:  # noqa: BLE001 - what can't be decoded can't be repaired
            return None, False

    return one


def validated_files(files: DataFrame, decoders: S.Decoders | None = None) -> DataFrame:
    """The report of a folder: (path, valid, message, seconds, repaired, content): every file checked; of those that fail, what a repair gives, content null where it gives nothing. Valid files have content null, too: they stay as they are. A file is a row from probe to repair: contents are neither shuffled nor joined."""
    check = L.audio_check(F.col("length"), F.col("readable"), F.col("seconds"), F.col("corrupt"))
    checked = _probes(files, decoders).select("path", check.alias("c"), "seconds", "content")
    bad = checked.select("path", "c.valid", "c.message", "seconds", F.when(~F.col("c.valid"), F.col("content")).alias("content"))
    repair = _repairer(decoders=decoders)

    def one(path: str, valid: bool, message: str, seconds: float, content: bytes | None) -> tuple:
        new, ok = (None, None) if valid else repair(content)
        return path, valid, message, seconds, ok, new if ok else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "valid", "message", "seconds"]
        for pdf in batches:
            yield from in_batches(map(one, *(pdf[c] for c in [*columns, "content"])), [*columns, "repaired", "content"])

    return bad.mapInPandas(run, "path string, valid boolean, message string, seconds double, repaired boolean, content binary")


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _settle(spark: SparkSession, path: str) -> None:
    """Ends a replacement that was broken off: a table that is only there under its old name gets its name back."""
    now, fs = _path(spark, path)
    old, _ = _path(spark, f"{path}.old")
    if not fs.exists(now) and fs.exists(old):
        fs.rename(old, now)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one where there is none."""
    _settle(spark, path)
    at, fs = _path(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(at) else spark.createDataFrame([], schema)


def replace(df: DataFrame, path: str, *partitions: str) -> None:
    """Writes beside the table, renames the old one aside, then the new one in; df may read from the table. Whenever it is broken off, the old table or the new one is there, if need be under its name for a replacement, which the next read or write puts right."""
    spark = df.sparkSession
    _settle(spark, path)
    df.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}.new")
    (now, fs), (new, _), (old, _) = _path(spark, path), _path(spark, f"{path}.new"), _path(spark, f"{path}.old")
    fs.delete(old, True)
    if fs.exists(now) and not fs.rename(now, old):
        raise OSError(f"{path} can't be renamed")
    if not fs.rename(new, now):
        raise OSError(f"{path}.new can't be renamed")
    fs.delete(old, True)


def log(changes: DataFrame, path: str, number: int) -> None:
    """Changes of a registry as a folder of its log, by number; the same number again replaces it."""
    changes.write.mode("overwrite").parquet(f"{path}/batch={number}")


def logged(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The registry of a log: the latest row of each video_id, of equal times the one of the higher number; of folders below ``before`` alone, if given."""
    rows = read_or_empty(spark, path, REGISTRY + ", batch long")
    rows = rows if before is None else rows.where(F.col("batch") < before)
    rank = F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc_nulls_last("timestamp"), F.desc("batch")))
    return rows.withColumn("__k", rank).where("__k = 1").drop("__k", "batch")


def compacted(spark: SparkSession, path: str) -> None:
    """One folder of a log's many, numbered as the last, with the latest rows alone. Not while a stream writes to it."""
    last = read_or_empty(spark, path, REGISTRY + ", batch long").agg(F.max("batch")).first()[0]
    if last is not None:
        replace(logged(spark, path).withColumn("batch", F.lit(last)), path, "batch")


def registry(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, REGISTRY)


def cache(spark: SparkSession, path: str, now=None, days: int | None = C.DAYS) -> DataFrame:
    """Entries that haven't expired."""
    return C.live(read_or_empty(spark, path, CACHE), F.current_timestamp() if now is None else now, days)


def bank(spark: SparkSession, path: str) -> DataFrame:
    """Speakers, their embeddings of length 1."""
    return read_or_empty(spark, path, BANK).withColumn("embedding", V.unit(F.col("embedding")))


def write_bank(speakers: DataFrame, path: str) -> None:
    replace(speakers.select("speaker_id", V.unit(F.col("embedding")).cast("array<float>").alias("embedding"), "occurrences", "last_seen"), path)


def write_cache(entries: DataFrame, path: str, stats: dict[str, int] | None = None, version: str = "2.0") -> None:
    """The entries, and beside them an envelope: version, time, number of entries, and the counts given."""
    spark = entries.sparkSession
    replace(entries, path)
    count = spark.read.parquet(path).count()
    body = {"version": version, "entries_count": count, "stats": stats or {}}
    envelope = spark.createDataFrame([(json.dumps(body),)], "body string").select(F.col("body"), F.current_timestamp().alias("updated_at"))
    replace(envelope, f"{path}.envelope")


def cache_envelope(spark: SparkSession, path: str) -> dict:
    """What ``write_cache`` says of the entries; {} where there is none."""
    rows = read_or_empty(spark, f"{path}.envelope", "body string, updated_at timestamp").collect()
    return json.loads(rows[0]["body"]) | {"updated_at": rows[0]["updated_at"]} if rows else {}


def _by_recording(rows: DataFrame) -> DataFrame:
    """rows by recording, over all cores: a folder costs its task more than the few rows in it, by whose bytes tasks would else be few."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "podcast_id")


def write_metadata(rows: DataFrame, path: str) -> None:
    """A folder of JSON lines for each recording."""
    _by_recording(rows).write.mode("overwrite").partitionBy("podcast_id").json(path)


def write_consolidated(rows: DataFrame, path: str) -> None:
    """Metadata of all recordings in one table of JSON lines, whatever its number of files."""
    rows.write.mode("overwrite").json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """The log of runs: a JSON line of nested figures for each recording, in a folder of its own; other recordings' folders stay."""
    _by_recording(metrics).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("podcast_id").json(path)


def write_glossary(rules: DataFrame, path: str) -> None:
    """Rules in order of error, as JSON lines."""
    rules.orderBy("error").coalesce(1).write.mode("overwrite").json(path)


def glossary(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(error, correction) of a glossary file's "correcciones", in its order; [] where there is none."""
    return list(config(spark, path).get("correcciones", {}).items())


def load_glossary(spark: SparkSession, path: str | None, base: dict | None = None) -> dict:
    """A whole glossary: the base, by default the built-in one, and the file's keys merged into it."""
    return G.merged_keys(G.default_glossary() if base is None else base, config(spark, path) if path else {})


def save_glossary(spark: SparkSession, g: dict, path: str) -> None:
    """The glossary file: rules in order of error, listed terms once each, other keys as they are. Small, and a file that people edit, so written by the driver, beside the old one, which is then replaced."""
    out = {k: dict(sorted(v.items())) if isinstance(v, dict) else list(dict.fromkeys(v)) if isinstance(v, list) else v for k, v in g.items()}
    (new, fs), (now, _) = _path(spark, f"{path}.new"), _path(spark, path)
    stream = fs.create(new, True)
    stream.write(bytearray(json.dumps(out, ensure_ascii=False, indent=2).encode()))
    stream.close()
    fs.delete(now, False)
    fs.rename(new, now)


def write_default_glossary(spark: SparkSession, path: str) -> None:
    """The built-in glossary as a file to begin with."""
    save_glossary(spark, G.default_glossary(), path)
