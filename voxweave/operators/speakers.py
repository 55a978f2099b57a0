"""Speakers: nearest match in a bank, embeddings of local speakers, online clustering over recordings."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.text import fallback_speaker

THRESHOLD = 0.85


#: So many bytes of the bank are sent to tasks at once.
BANK_BYTES = 32 << 20


def nearest(queries: DataFrame, bank: DataFrame, threshold: float = THRESHOLD, bank_bytes: int = BANK_BYTES) -> DataFrame:
    """(query_id, speaker_id, score): the bank's most similar speaker of each embedding, null below the threshold; of equals the lowest id. An empty bank, or an embedding that isn't valid, gives null and 0; one of another length than all the bank's, null and -1.

    Exact: every pair is scored, by products of matrices. The bank is counted and sent in blocks of at most ``bank_bytes``, each a pass over the queries, which aren't shuffled unless there are several.
    """
    kind = dict(queries.dtypes)["query_id"]
    valid = bank.where(V.valid(F.col("embedding"))).select(F.col("speaker_id").cast("string").alias("speaker_id"), V.unit(F.col("embedding")).alias("b"))
    counted = valid.agg(F.coalesce(F.sum(F.size("b") * 8 + 64), F.lit(0)).alias("bytes")).first()["bytes"]
    parts = max(1, -(-counted // bank_bytes))
    numbered = valid.withColumn("part", F.pmod(F.xxhash64("speaker_id"), F.lit(parts)))
    q = queries.select("query_id", F.when(V.valid(F.col("embedding")), V.unit(F.col("embedding"))).alias("q"))
    out = None
    for part in range(parts):
        rows = numbered.where(F.col("part") == part).orderBy("speaker_id").select("speaker_id", "b").collect()
        blocks: dict[int, tuple[list[str], list]] = {}
        for r in rows:
            ids, vectors = blocks.setdefault(len(r["b"]), ([], []))
            ids.append(r["speaker_id"])
            vectors.append(r["b"])
        sent = queries.sparkSession.sparkContext.broadcast({n: (ids, np.array(v)) for n, (ids, v) in blocks.items()})

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                best, score = [None] * len(pdf), np.zeros(len(pdf))
                length = np.array([0 if v is None else len(v) for v in pdf["q"]])
                score[(length > 0) & bool(sent.value)] = -1.0
                for n, (ids, vectors) in sent.value.items():
                    at = np.flatnonzero(length == n)
                    for k in range(0, len(at), 1024):
                        own = at[k : k + 1024]
                        products = np.stack(pdf["q"].iloc[own].to_list()) @ vectors.T
                        top = products.argmax(axis=1)
                        score[own] = products[np.arange(len(own)), top]
                        for i, t in zip(own.tolist(), top.tolist()):
                            best[i] = ids[t]
                yield pd.DataFrame({"query_id": pdf["query_id"], "best": best, "score": score})

        found = q.mapInPandas(run, f"query_id {kind}, best string, score double")
        out = found if out is None else out.unionByName(found)
    if parts > 1:
        out = out.groupBy("query_id").agg(F.min_by("best", F.struct((-F.col("score")).alias("s"), F.col("best").alias("i"))).alias("best"), F.max("score").alias("score"))
    return out.select("query_id", F.when(F.col("score") >= threshold, F.col("best")).alias("speaker_id"), "score")


def longest(turns: DataFrame, most: int = 5, preferred: float = 2.0, least: float = 1.0) -> DataFrame:
    """Turns an embedding is made from: the longest of a speaker, ``most`` of at least ``preferred``; where there is none, all of at least ``least``."""
    by = Window.partitionBy("podcast_id", "speaker")
    long = F.col("duration") >= preferred
    seen = turns.where(F.col("duration") >= least).withColumn("some", F.max(long.cast("int")).over(by))
    rank = F.row_number().over(by.orderBy(F.desc("duration"), "turn_idx"))
    return seen.where(long | (F.col("some") == 0)).withColumn("rank", rank).where((F.col("rank") <= most) | (F.col("some") == 0)).drop("some", "rank")


def mean_embedding(parts: DataFrame, *keys: str) -> DataFrame:
    """(keys, embedding): mean by dimension of valid embeddings, of length 1; null where there is none. Tasks add up their vectors, so a row for each key and task is shuffled."""
    kinds = dict(parts.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", total array<double>, n long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, list] = {}
        for pdf in batches:
            for key, own in pdf.groupby(list(keys), dropna=False, sort=False):
                vectors = [v for v in own["e"] if v is not None]
                width = max((len(v) for v in vectors), default=0)
                total = np.zeros(width)
                for v in vectors:
                    total[: len(v)] += v
                held = sums.setdefault(tuple(None if x != x else x for x in key), [np.zeros(0), 0])
                if len(held[0]) < width:
                    held[0] = np.pad(held[0], (0, width - len(held[0])))
                held[0][:width] += total
                held[1] += len(vectors)
        yield pd.DataFrame([(*k, t.tolist(), n) for k, (t, n) in sums.items()], columns=[*keys, "total", "n"])

    partial = parts.select(*keys, F.when(V.valid(F.col("embedding")), V.doubles(F.col("embedding"))).alias("e")).mapInPandas(run, schema)
    many = partial.groupBy(*keys).agg(F.sum("n").alias("n"))
    flat = partial.select(*keys, F.posexplode("total").alias("dim", "x")).groupBy(*keys, "dim").agg(F.sum("x").alias("x"))
    gathered = flat.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("e"))
    both = many.join(gathered, list(keys), "left").withColumn("e", F.transform("e", lambda x: x / F.col("n")))
    return both.select(*keys, F.when(V.valid(F.col("e")), V.unit(F.col("e"))).alias("embedding"))


def with_global_ids(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Turns with the global id of their speaker, or a code from the label; speaker_local keeps the label. An empty map leaves turns as they are."""
    if ids.isEmpty():
        return turns.withColumn("speaker_local", F.lit(None).cast("string"))
    named = ids.select(F.col("podcast_id").alias("__p"), F.col("speaker").alias("__s"), "global_id")
    joined = turns.join(named, (F.col("podcast_id") == F.col("__p")) & (F.col("speaker") == F.col("__s")), "left")
    return joined.withColumn("speaker_local", F.col("speaker")).withColumn("speaker", F.coalesce("global_id", fallback_speaker(F.col("speaker")))).drop("__p", "__s", "global_id")


def next_id(ids: list[str], made: Callable[[int], str] | None = None, pattern: str = "SPEAKER_GLOBAL_%03d") -> str:
    """An id for a new speaker: of the caller's making, or one more than the highest number."""
    if made:
        return made(len(ids) + 1)
    return pattern % (max((int(m[1]) for i in ids if (m := re.search(r"(\d+)$", i))), default=0) + 1)


class Bank:
    """A speaker bank: embeddings of length 1 with the times each was met. ``match``, ``add`` and ``update`` are the steps of the online fold.

    Embeddings are rows of one matrix that grows by doubling, and the highest number of an id is kept, so a meeting costs one product of the matrix.
    ``meet_all`` shares that product between the meetings of a block: it is made in single precision, and what comes within its error of the best is scored exactly.
    """

    #: Meetings of a block at most, scores that are held for one, and threads that share the product: the fold is one task, beside which an executor's other cores have nothing to do.
    BLOCK, SCORES, THREADS = 256, 1 << 24, 4
    #: Values of a bank up to which each meeting has a product of its own.
    SMALL = 1 << 14

    def __init__(self, threshold: float = THRESHOLD, made: Callable[[int], str] | None = None):
        self.threshold, self.made = threshold, made
        self.ids: list[str] = []
        self.times: list[int] = []
        self.at: dict[str, int] = {}
        self.highest, self.mixed = 0, False
        self._rows = np.zeros((0, 0))
        self._near = np.zeros((0, 0), np.float32)  # the same in single precision
        self._scores = np.zeros(0, np.float32)
        self._odd: list[np.ndarray] = []  # all vectors, where their lengths differ

    @property
    def vectors(self) -> list[np.ndarray]:
        return self._odd if self.mixed else list(self._rows[: len(self.ids)])

    def load(self, name: str, e: np.ndarray, times: int) -> None:
        """One speaker more, of a known id."""
        v = self.unit(np.asarray(e, np.float64))
        n = len(self.ids)
        if not self.mixed and n and len(v) != self._rows.shape[1]:
            self._odd, self.mixed = self.vectors, True
        if self.mixed:
            self._odd.append(v)
        else:
            if n == len(self._rows):
                self._rows = np.concatenate([self._rows.reshape(n, len(v)), np.zeros((max(8, n), len(v)))])
                self._near = np.concatenate([self._near.reshape(n, len(v)), np.zeros((max(8, n), len(v)), np.float32)])
            self._rows[n] = self._near[n] = v
        self.ids.append(name)
        self.times.append(times)
        self.at.setdefault(name, n)
        if m := re.search(r"(\d+)$", name):
            self.highest = max(self.highest, int(m[1]))

    @staticmethod
    def valid(e: np.ndarray | None) -> bool:
        return e is not None and len(e) > 0 and bool(np.isfinite(e).all()) and float(np.linalg.norm(e)) > 0

    @staticmethod
    def unit(e: np.ndarray) -> np.ndarray:
        n = np.linalg.norm(e)
        return e / n if n > 0 else e

    def match(self, e: np.ndarray | None) -> tuple[str | None, float]:
        n = len(self.ids)
        if not n or not self.valid(e) or self.mixed or self._rows.shape[1] != len(e):
            return None, 0.0
        scores = self._rows[:n] @ self.unit(np.asarray(e, np.float64))
        at = int(np.argmax(scores))
        return (self.ids[at] if scores[at] >= self.threshold else None), float(scores[at])

    def add(self, e: np.ndarray | None) -> str | None:
        if not self.valid(e):
            return None
        self.load(self.made(len(self.ids) + 1) if self.made else f"SPEAKER_GLOBAL_{self.highest + 1:03d}", e, 1)
        return self.ids[-1]

    def update(self, name: str, e: np.ndarray) -> None:
        if name in self.at and self.valid(e):
            at = self.at[name]
            old = self.vectors[at] if self.mixed else self._rows[at]
            if len(old) != len(e):
                return
            new = self.unit((old * self.times[at] + self.unit(np.asarray(e, np.float64))) / (self.times[at] + 1))
            if self.mixed:
                self._odd[at] = new
            else:
                self._rows[at] = self._near[at] = new
            self.times[at] += 1

    def _update(self, at: int, u: np.ndarray) -> None:
        t = self.times[at]
        new = (self._rows[at] * t + u) / (t + 1)
        norm = math.sqrt(new.dot(new))
        self._rows[at] = self._near[at] = new / norm if norm > 0 else new
        self.times[at] += 1

    def meet(self, e: np.ndarray | None) -> tuple[str | None, float, bool]:
        """(global id, score, whether it is new)."""
        n = len(self.ids)
        if n and e is not None and not self.mixed and len(e) == self._rows.shape[1]:
            e = np.asarray(e, np.float64)
            norm = math.sqrt(e.dot(e))
            if 0 < norm < math.inf:  # what else is valid goes the longer way
                u = e / norm
                scores = self._rows[:n] @ u
                at = int(scores.argmax())
                score = float(scores[at])
                if score >= self.threshold:
                    name = self.ids[at]
                    self._update(self.at[name], u)
                    return name, score, False
                return self.add(e), score, True
        name, score = self.match(e)
        if name is not None:
            self.update(name, e)
            return name, score, False
        new = self.add(e)
        return new, score, new is not None

    def meet_all(self, es: list[np.ndarray | None]) -> list[tuple[str | None, float, bool]]:
        """``meet`` of each, in order, in blocks of valid embeddings of the bank's length."""
        out: list[tuple[str | None, float, bool]] = []
        while (k := len(out)) < len(es):
            n, block = len(self.ids), []
            if n and not self.mixed and self._rows.shape[1] * n > self.SMALL:
                most = max(1, min(self.BLOCK, self.SCORES // n))
                for e in es[k : k + most]:
                    if not self.valid(e) or len(e) != self._rows.shape[1]:
                        break
                    block.append(self.unit(np.asarray(e, np.float64)))
            out += self._meet_block(np.stack(block), es[k : k + len(block)]) if len(block) > 1 else [self.meet(es[k])]
        return out

    def _multiply(self, near: np.ndarray, scores: np.ndarray) -> None:
        n = scores.shape[1]
        part = lambda a, z: np.matmul(near, self._near[a:z].T, out=scores[:, a:z])
        if scores.size < 1 << 20 or self.THREADS < 2:
            part(0, n)
            return
        step = -(-n // self.THREADS)
        with ThreadPoolExecutor(self.THREADS) as pool:
            list(pool.map(part, range(0, n, step), [min(n, a + step) for a in range(0, n, step)]))

    def _meet_block(self, units: np.ndarray, es: list[np.ndarray]) -> list[tuple[str | None, float, bool]]:
        n, (count, width) = len(self.ids), units.shape
        near = units.astype(np.float32)
        if len(self._scores) < count * n:
            self._scores = np.empty(min(max(2 * count * n, 1 << 20), max(self.SCORES, count * n)), np.float32)
        scores = self._scores[: count * n].reshape(count, n)
        self._multiply(near, scores)
        fresh = np.empty((count, count), np.float32)  # of speakers that are new in this block
        error = 2 * (width + 4) * float(np.finfo(np.float32).eps)
        out: list[tuple[str | None, float, bool]] = []
        for j in range(count):
            known = len(self.ids)
            row, new = scores[j], fresh[j, : known - n]
            least = max(float(row.max()), float(new.max(initial=-2.0))) - error
            may = np.concatenate([np.flatnonzero(row >= least), n + np.flatnonzero(new >= least)])
            exact = self._rows[may] @ units[j]
            best = int(np.argmax(exact))
            score = float(exact[best])
            if score >= self.threshold:
                name = self.ids[may[best]]
                at, result = self.at[name], (name, score, False)
                self._update(at, units[j])
            else:
                made = self.add(es[j])
                at, result = known, (made, score, made is not None)
            if at < n:
                scores[j + 1 :, at] = near[j + 1 :] @ self._near[at]
            else:
                fresh[j + 1 :, at - n] = near[j + 1 :] @ self._near[at]
            out.append(result)
        return out


def clustered(speakers: DataFrame, bank: DataFrame | None = None, threshold: float = THRESHOLD, made: Callable[[int], str] | None = None) -> DataFrame:
    """(podcast_id, speaker, global_id, score, created): local speakers (podcast_id, speaker, embedding, seq) meet the bank in order of seq.

    Each meeting changes the bank, so the order is the semantics and the fold of a bank is one task, which holds the bank and a batch of rows: rows are sorted before it and
    go through it as a stream. Embeddings are made before it, in parallel, and a row is one speaker of one recording. Rows of several banks can be folded side by side by a column
    bank_id. A given bank is state of that fold, so it is read by the driver; ``sources.bank`` keeps it as a table. Rows of equal seq go by podcast_id and speaker.
    """
    rows = speakers if "bank_id" in speakers.columns else speakers.withColumn("bank_id", F.lit(0))
    old = [] if bank is None else [(r["speaker_id"], list(r["embedding"]), r["occurrences"]) for r in bank.orderBy("speaker_id").collect()]

    def begun() -> Bank:
        b = Bank(threshold, made)
        for name, e, n in old:
            b.load(name, np.asarray(e, np.float64), n)
        return b

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b, key = None, None
        for pdf in batches:
            keys = [None if k != k else k for k in pdf["bank_id"]]
            starts = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]
            for at, end in zip(starts, [*starts[1:], len(keys)]):
                if b is None or keys[at] != key:
                    b, key = begun(), keys[at]
                own = pdf.iloc[at:end]
                met = b.meet_all([None if e is None else np.asarray(e, np.float64) for e in own["embedding"]])
                yield pd.DataFrame({"podcast_id": own["podcast_id"].to_numpy(), "speaker": own["speaker"].to_numpy(), "global_id": [m[0] for m in met], "score": [m[1] for m in met], "created": [m[2] for m in met]})

    kind = dict(speakers.dtypes)["podcast_id"]
    ordered = rows.select("bank_id", "podcast_id", "speaker", "embedding", "seq").repartition("bank_id").sortWithinPartitions("bank_id", F.asc_nulls_last("seq"), "podcast_id", "speaker")
    return ordered.mapInPandas(fold, f"podcast_id {kind}, speaker string, global_id string, score double, created boolean")


def bank_counts(met: DataFrame) -> DataFrame:
    """(podcast_id, matched, created)."""
    return met.groupBy("podcast_id").agg(F.count_if(~F.col("created") & F.col("global_id").isNotNull()).alias("matched"), F.count_if("created").alias("created"))

