"""Sound: energies and turns from them by window functions, and numpy kernels over decoded audio."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .spread import in_batches


def window_energy(samples: DataFrame, width: int) -> DataFrame:
    """(podcast_id, window, energy, start, end) of samples (podcast_id, idx, t, x): mean square of each ``width`` consecutive samples."""
    return samples.groupBy("podcast_id", F.floor(F.col("idx") / width).alias("window")).agg(F.avg(F.col("x") * F.col("x")).alias("energy"), F.min("t").alias("start"), F.max("t").alias("end"))


def energy_turns(energies: DataFrame, durations: DataFrame, share: float = 0.5, labels: int = 3) -> DataFrame:
    """Turns (podcast_id, turn_idx, start, end, speaker) from energies alone: where the step between windows exceeds ``share`` of the recording's median, the next of ``labels`` labels begins. A turn ends where the next begins, the last at the recording's end."""
    order = Window.partitionBy("podcast_id").orderBy("window")
    medians = energies.groupBy("podcast_id").agg(F.median("energy").alias("median"))
    flagged = energies.join(medians, "podcast_id").withColumn("change", F.coalesce((F.abs(F.col("energy") - F.lag("energy").over(order)) > share * F.col("median")).cast("int"), F.lit(0)))
    runs = flagged.withColumn("turn_idx", F.sum("change").over(order)).groupBy("podcast_id", "turn_idx").agg(F.min("start").alias("start"))
    turn = Window.partitionBy("podcast_id").orderBy("turn_idx")
    ended = runs.join(durations, "podcast_id").withColumn("end", F.coalesce(F.lead("start").over(turn), F.col("duration")))
    return ended.select("podcast_id", "turn_idx", "start", "end", F.format_string("SPEAKER_%02d", F.pmod("turn_idx", F.lit(labels))).alias("speaker"))


def next_starts(turns: DataFrame, durations: DataFrame) -> DataFrame:
    """Turns whose end is the next start, the last one's the recording's duration."""
    order = Window.partitionBy("podcast_id").orderBy("start", "turn_idx")
    return turns.drop("end").join(durations, "podcast_id").withColumn("end", F.coalesce(F.lead("start").over(order), F.col("duration"))).drop("duration")


def sliding_rms(samples: DataFrame, width: int, hop: int) -> DataFrame:
    """(podcast_id, frame, rms) of frames of ``width`` samples every ``hop``; only whole frames."""
    counts = samples.groupBy("podcast_id").agg(F.max("idx").alias("last"))
    frames = samples.withColumn("frame", F.explode(F.sequence(F.greatest(F.ceil((F.col("idx") - width + 1) / hop), F.lit(0)), F.floor(F.col("idx") / hop))))
    whole = frames.join(counts, "podcast_id").where(F.col("frame") * hop + width - 1 <= F.col("last"))
    return whole.groupBy("podcast_id", "frame").agg(F.sqrt(F.avg(F.col("x") * F.col("x"))).alias("rms"))


def signal_stats(samples: DataFrame) -> DataFrame:
    """(podcast_id, peak, rms) of samples (podcast_id, x), by plain aggregates."""
    return samples.groupBy("podcast_id").agg(F.max(F.abs("x")).alias("peak"), F.sqrt(F.avg(F.col("x") * F.col("x"))).alias("rms"))


# numpy kernels

Sound = tuple[np.ndarray, int]
#: Decoders by format, for what isn't WAV: content -> (mono samples, rate).
Decoders = dict[str, Callable[[bytes], Sound]]


class UnsupportedError(ValueError):
    """A known format of sound for which there is no decoder."""


def audio_format(content: bytes | None) -> str | None:
    """wav, mp3, flac, ogg, m4a or webm by what a file begins with, or None."""
    c = content or b""
    if c[:4] == b"RIFF" and c[8:12] == b"WAVE":
        return "wav"
    if c[:3] == b"ID3" or len(c) > 1 and c[0] == 0xFF and c[1] & 0xE0 == 0xE0:
        return "mp3"
    if c[4:8] == b"ftyp":
        return "m4a"
    return {b"fLaC": "flac", b"OggS": "ogg", b"\x1aE\xdf\xa3": "webm"}.get(c[:4])


def decode(content: bytes | None, decoders: Decoders | None = None) -> Sound:
    """Mono samples and rate, by the decoder of the content's format; WAV needs none."""
    kind = audio_format(content)
    if kind is None:
        raise ValueError("not sound of a known format")
    if decoders and kind in decoders:
        return decoders[kind](content)
    if kind != "wav":
        raise UnsupportedError(f"no decoder for {kind}")
    return decode_wav(content)


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """Mono float samples and rate of PCM of 8, 16, 24 or 32 bits; channels are averaged."""
    with wave.open(io.BytesIO(content)) as w:
        rate, width, channels, raw = w.getframerate(), w.getsampwidth(), w.getnchannels(), w.readframes(w.getnframes())
    if width == 1:
        x = np.frombuffer(raw, np.uint8).astype(np.float64) / 128 - 1
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)
    elif width in (2, 4):
        x = np.frombuffer(raw, f"<i{width}").astype(np.float64) / float(1 << (8 * width - 1))
    else:
        raise ValueError(f"samples of {8 * width} bits")
    return x.reshape(-1, channels).mean(axis=1), rate


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """PCM of 16 bits."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.round(x * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation at the target rate."""
    if rate == target or not len(x):
        return x
    n = max(1, round(len(x) * target / rate))
    return np.interp(np.arange(n) * rate / target, np.arange(len(x)), x)


def level(x: np.ndarray) -> float:
    return float(np.sqrt(np.mean(x * x))) if len(x) else 0.0


def normalise(x: np.ndarray, rate: int, target: int = 22050, lufs: float = -23.0, peak: bool = True) -> np.ndarray:
    """Resampled, brought to the loudness, limited at -1 dB and clipped."""
    x = resample(x, rate, target)
    if (now := level(x)) > 0:
        x = x * (10 ** ((lufs + 0.691) / 20) / now)
    limit = 10 ** (-1 / 20)
    if peak and len(x) and (most := np.abs(x).max()) > limit:
        x = x * (limit / most)
    return np.clip(x, -1, 1)


def quiet_parts(x: np.ndarray, rate: int, threshold: float = -40.0, least: float = 0.5, keep: float = 0.2) -> list[tuple[float, float]]:
    """(start, end) in seconds of the parts between silences: runs of ``least`` seconds or more below ``threshold`` dBFS, of which ``keep`` stay at each side."""
    step = max(1, rate // 100)
    frames = [20 * math.log10(max(level(x[a : a + step]), 1e-10)) >= threshold for a in range(0, len(x), step)]
    total, out, at = len(x) / rate, [], 0
    loud = [k for k, f in enumerate(frames) if f]
    if not loud:
        return []
    begin = prev = loud[0]
    spans = []
    for k in loud[1:]:
        if (k - prev - 1) * step / rate >= least:
            spans.append((begin, prev + 1))
            begin = k
        prev = k
    spans.append((begin, prev + 1))
    for a, z in spans:
        a, z = max(at, a * step / rate - keep), min(total, z * step / rate + keep)
        out.append((a, z))
        at = z
    return out


def best_cut(x: np.ndarray, rate: int, start: float, target: float, least: float, search: float = 1.0) -> float:
    """The quietest place within ``search`` seconds of target: the start of the 50 ms frame of the lowest RMS, not before start + least; target where there is none."""
    lo, hi = max(start + least, target - search), min(target + search, len(x) / rate)
    part, width = x[int(lo * rate) : max(int(lo * rate), int(hi * rate))], max(1, int(0.05 * rate))
    places = range(0, len(part) - width, max(1, width // 2))
    if hi <= lo or not len(places):
        return target
    cut = lo + min(places, key=lambda p: (level(part[p : p + width]), p)) / rate
    return cut if cut - start >= least else target


def split_long(x: np.ndarray, rate: int, start: float, end: float, max_length: float = 15, min_length: float = 10) -> list[tuple[float, float]]:
    """Pieces of a long turn, each cut but the last moved to the quietest place near max_length; pieces below min_length are skipped."""
    out, at = [], start
    while at < end:
        stop = min(at + max_length, end)
        if stop - at >= min_length:
            if stop < end:
                stop = best_cut(x, rate, at, stop, min_length)
            out.append((at, stop))
        at = stop
    return out


def turns_by_energy(x: np.ndarray, rate: int, width: float = 2.0, share: float = 0.5, labels: int = 3) -> list[tuple[float, float, str]]:
    """(start, end, speaker) as ``energy_turns`` gives, of one recording's samples."""
    step = max(1, int(rate * width))
    energy = [float(np.mean(x[a : a + step] ** 2)) for a in range(0, len(x), step)]
    if not energy:
        return [(0.0, len(x) / rate, "SPEAKER_00")]
    limit, speaker, out = share * float(np.median(energy)), 0, [(0.0, 0)]
    for k in range(1, len(energy)):
        if abs(energy[k] - energy[k - 1]) > limit:
            speaker = (speaker + 1) % labels
            out.append((k * step / rate, speaker))
    ends = [a for a, _ in out[1:]] + [len(x) / rate]
    return [(a, z, f"SPEAKER_{n:02d}") for (a, n), z in zip(out, ends)]


Diarizer = Callable[[bytes], list[dict]]


def diarized(files: DataFrame, diarizer: Diarizer | None = None, decoders: Decoders | None = None) -> DataFrame:
    """(podcast_id, turn_idx, start, end, speaker, method, error) of files (podcast_id, content): turns (start, end, speaker) of a given model, method 'model'; where there is none, or it fails or finds nothing, turns by energy ('energy'); where the sound can't be read, one turn of SPEAKER_00 without length ('none')."""

    def one(content: bytes | None) -> tuple[list[tuple[float, float, str]], str, str | None]:
        error = None
        if diarizer:
            try:
                if got := [(float(t["start"]), float(t["end"]), str(t["speaker"])) for t in diarizer(content)]:
                    return got, "model", None
                error = "the model found no turns"
            except Exception as e:  # noqa: BLE001 - a model's failure is what the fallback is for
                error = str(e) or type(e).__name__
        try:
            return turns_by_energy(*decode(content, decoders)), "energy", error
        except Exception as e:  # noqa: BLE001 - a row, not a task's failure
            return [(0.0, 0.0, "SPEAKER_00")], "none", str(e) or type(e).__name__

    def rows(pdf: pd.DataFrame) -> Iterator[tuple]:
        for name, content in zip(pdf["podcast_id"], pdf["content"]):
            turns, method, error = one(content)
            for k, t in enumerate(turns):
                yield (name, k, *t, method, error)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from in_batches(rows(pdf), ["podcast_id", "turn_idx", "start", "end", "speaker", "method", "error"])

    return files.select("podcast_id", "content").mapInPandas(run, "podcast_id string, turn_idx long, start double, end double, speaker string, method string, error string")


def _with_sound(parts: DataFrame, files: DataFrame) -> DataFrame:
    """(podcast_id, parts, there, content): all parts (podcast_id, part) of each recording in order, with its file in files (podcast_id, content), of several one. A row is a recording, so that many go through Python at once; both sides are shuffled once, and neither is sent to all tasks."""
    kind = dict(parts.dtypes)["part"]
    sound = files.select("podcast_id", F.lit(None).cast(kind).alias("part"), F.struct("content").alias("file"))
    both = parts.select("podcast_id", "part", F.lit(None).cast("struct<content:binary>").alias("file")).unionByName(sound)
    gathered = both.groupBy("podcast_id").agg(F.array_sort(F.collect_list("part")).alias("parts"), F.first("file", ignorenulls=True).alias("file")).where(F.size("parts") > 0)
    return gathered.select("podcast_id", "parts", F.col("file").isNotNull().alias("there"), F.col("file.content").alias("content"))


def _sound(there: bool, content: bytes | None, decoders: Decoders | None) -> tuple[np.ndarray, int, str | None]:
    """(samples, rate, error) of a recording's file, if it is there."""
    try:
        if not there:
            raise ValueError("no file")
        return *decode(content, decoders), None
    except Exception as e:  # noqa: BLE001 - a row, not a task's failure
        return np.zeros(0), 1, str(e) or type(e).__name__


def split_turns(turns: DataFrame, files: DataFrame, max_length: float = 15, min_length: float = 10, decoders: Decoders | None = None) -> DataFrame:
    """Segments (podcast_id, seg_idx, start, end, speaker, error) of turns (podcast_id, turn_idx, start, end, speaker), long ones cut at quiet places of the sound in files (podcast_id, content), which is decoded once a recording. Turns are clamped to the sound; short ones go. Without readable sound long turns are cut at max_length, and error says why."""
    kind = dict(turns.dtypes)["podcast_id"]

    def one(name: object, parts: list, there: bool, content: bytes | None) -> Iterator[tuple]:
        x, rate, error = _sound(there, content, decoders)
        k = 0
        for t in parts:
            start, end = max(0.0, float(t["start"])), float(t["end"]) if error else min(float(t["end"]), len(x) / rate)
            if end - start >= min_length:
                for a, z in split_long(x, rate, start, end, max_length, min_length):
                    yield name, k, a, z, t["speaker"], error
                    k += 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = (r for own in zip(pdf["podcast_id"], pdf["parts"], pdf["there"], pdf["content"]) for r in one(*own))
            yield from in_batches(rows, ["podcast_id", "seg_idx", "start", "end", "speaker", "error"])

    both = _with_sound(turns.select("podcast_id", F.struct("start", "turn_idx", "end", "speaker").alias("part")), files)
    return both.mapInPandas(run, f"podcast_id {kind}, seg_idx long, start double, end double, speaker string, error string")


def converted_files(files: DataFrame, rate: int | None = None, decoders: Decoders | None = None) -> DataFrame:
    """(path, content, error): files of any format that can be decoded as WAV, at ``rate`` or their own."""

    def one(path: str, content: bytes | None) -> tuple:
        try:
            x, own = decode(content, decoders)
            return path, encode_wav(resample(x, own, rate or own), rate or own), None
        except Exception as e:  # noqa: BLE001 - a row, not a task's failure
            return path, None, str(e) or type(e).__name__

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from in_batches(map(one, pdf["path"], pdf["content"]), ["path", "content", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, content binary, error string")


def normalised_files(files: DataFrame, target: int = 22050, lufs: float = -23.0, peak: bool = True, decoders: Decoders | None = None) -> DataFrame:
    """(path, content, sample_rate, peak, rms, loudness, duration, error) of files (path, content); a file that can't be read gives an error and no content."""

    def one(path: str, content: bytes | None) -> tuple:
        try:
            x = normalise(*decode(content, decoders), target, lufs, peak)
            r = level(x)
            return path, encode_wav(x, target), target, float(np.abs(x).max(initial=0)), r, 20 * math.log10(r) - 0.691 if r > 0 else float("-inf"), len(x) / target, None
        except Exception as e:  # noqa: BLE001 - a row, not a task's failure
            return path, None, None, None, None, None, None, str(e) or type(e).__name__

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from in_batches(map(one, pdf["path"], pdf["content"]), ["path", "content", "sample_rate", "peak", "rms", "loudness", "duration", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, content binary, sample_rate int, peak double, rms double, loudness double, duration double, error string")


def segmented_files(files: DataFrame, max_length: float = 15, min_length: float = 10, threshold: float = -40.0, decoders: Decoders | None = None) -> DataFrame:
    """(podcast_id, chunk_idx, duration, error) between silences, for ``intervals.filled``; a file that can't be read is one row with an error alone."""

    def one(p: str, c: bytes | None) -> list[tuple]:
        try:
            return [(p, k, z - a, None) for k, (a, z) in enumerate(quiet_parts(*decode(c, decoders), threshold))]
        except Exception as e:  # noqa: BLE001 - a row, not a task's failure
            return [(p, None, None, str(e) or type(e).__name__)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = (r for own in map(one, pdf["path"], pdf["content"]) for r in own)
            yield from in_batches(rows, ["podcast_id", "chunk_idx", "duration", "error"], {"chunk_idx": "Int32"})

    return files.select("path", "content").mapInPandas(run, "podcast_id string, chunk_idx int, duration double, error string")


def cut_files(segments: DataFrame, files: DataFrame, decoders: Decoders | None = None) -> DataFrame:
    """(podcast_id, seg_idx, path, content, error): the sound of each segment as WAV; files (podcast_id, content) are decoded once a recording. Segments of a file that isn't there or can't be read have an error and no content."""

    def one(name: str, parts: list, there: bool, content: bytes | None) -> Iterator[tuple]:
        x, rate, error = _sound(there, content, decoders)
        for s in parts:
            yield name, s["seg_idx"], f"{name}/seg_{s['seg_idx']:04d}.wav", None if error else encode_wav(x[int(s["start"] * rate) : int(s["end"] * rate)], rate), error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = (r for own in zip(pdf["podcast_id"], pdf["parts"], pdf["there"], pdf["content"]) for r in one(*own))
            yield from in_batches(rows, ["podcast_id", "seg_idx", "path", "content", "error"])

    both = _with_sound(segments.select("podcast_id", F.struct("seg_idx", "start", "end").alias("part")), files)
    return both.mapInPandas(run, "podcast_id string, seg_idx long, path string, content binary, error string")


Transcriber = Callable[[bytes], dict]


def transcribed(files: DataFrame, transcriber: Transcriber, **options: object) -> DataFrame:
    """(path, text, language, error) of each file by a given model; an error leaves the text blank."""

    def one(path: str, content: bytes | None) -> tuple:
        try:
            got = transcriber(content, **options)
            return path, got.get("text", ""), got.get("language", "unknown"), None
        except Exception as e:  # noqa: BLE001 - a model's failure is a row, not a task's
            return path, "", "unknown", str(e) or type(e).__name__

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from in_batches(map(one, pdf["path"], pdf["content"]), ["path", "text", "language", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, language string, error string")
