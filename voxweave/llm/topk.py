"""Exact top-k search over impact-ordered postings, score at a time.

``search(docs, queries, k)`` gives (query_id, rank, doc_id, score): for every row of queries the
k documents of the highest BM25 score; ties go to the lower doc_id. Scores are sums of
impacts rounded to millionths, so they don't depend on the order of adding.

How. (1) One pass counts documents, words, and in how many documents each query term occurs,
over all documents. (2) The second pass makes, in each task, indexes over runs of
its documents: postings of the queries' terms with their exact impacts, quantised upwards to
LEVELS steps and grouped to segments (term, level). For each query the segments of its
terms are taken by descending level, adding levels to accumulators. What is left of each
term can add at most the level of its next segment; the sum of those bounds every document not
yet seen, and with an accumulator every one that is. Processing stops only when that bound is
below the k-th best lower bound (or k-th exact score of earlier runs), and the documents that
may still be among the k are scored exactly. (3) The k best of each task are shuffled by
query and the k best of those kept.

Documents are spread as they are read, so indexes don't grow with the corpus but in number; a run
holds POSTINGS postings at most (or one batch). Queries are taken in runs of about ``block_bytes`` of text, so that
what is collected and sent is bounded (a query longer than that is sent whole); each run is two passes over the corpus, and its indexes live as long as their task.

Defined cases. Null and empty texts and queries match nothing. Very long texts and queries count whole. Empty tables give no rows. Ties go to the lower doc_id, of repeated rows to any, as they are alike. Only ids and texts are read, so other columns can't clash. Documents that share no term with
a query aren't results, so it may have fewer than k. Repeated rows are each a document (or query) of their
own; rows of null doc_id or query_id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .util import cut, keyed

TOP, K1, B = 10, 1.2, 0.75
LEVELS, POSTINGS, BLOCK_BYTES = 255, 4_000_000, 4 << 20
SCALE = 1e6


@dataclass
class Queries:
    ids: np.ndarray
    terms: np.ndarray  # sorted hashes of all queries' terms
    of: list[np.ndarray]  # indexes into terms, by query
    bitmap: np.ndarray


def queries_of(rows: list[tuple[int, str]]) -> Queries:
    raw, offsets = K.buffers(pa.array([t for _, t in rows], pa.string()))
    w = K.words(raw, offsets)
    terms = np.unique(w.hash)
    of = [np.unique(np.searchsorted(terms, w.hash[w.splits[i] : w.splits[i + 1]])) for i in range(len(rows))]
    bitmap = np.zeros(1 << 20, dtype=bool)
    bitmap[terms & np.uint64((1 << 20) - 1)] = True
    return Queries(np.array([i for i, _ in rows], np.int64), terms, of, bitmap)


def postings(q: Queries, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, row, term, count, words by row) of slices; rows count from the first."""
    raw, offsets = K.buffers(column)
    for i, j, part, off in K.slices(raw, offsets):
        w = K.words(part, off)
        hit = np.flatnonzero(q.bitmap[w.hash & np.uint64((1 << 20) - 1)])
        at = np.minimum(np.searchsorted(q.terms, w.hash[hit]), max(0, len(q.terms) - 1))
        good = q.terms[at] == w.hash[hit] if len(q.terms) else np.zeros(len(hit), dtype=bool)
        hit, at = hit[good], at[good]
        row = np.searchsorted(w.splits, hit, side="right") - 1
        keys, many = np.unique(row * max(1, len(q.terms)) + at, return_counts=True)
        yield i, j, keys // max(1, len(q.terms)), keys % max(1, len(q.terms)), many, np.diff(w.splits)


class Index:
    """Impact-ordered postings of a run of documents."""

    def __init__(self, ids: np.ndarray, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.ids = ids
        order = np.lexsort((row, term))
        self.row, self.impact = row[order], impact[order]
        self.splits = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.step = max(1, -(-int(impact.max(initial=0)) // LEVELS))
        level = -(-impact // self.step)
        by = np.lexsort((row, -level, term))
        self.by_row = row[by]
        t, v = term[by], level[by]
        first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (v[1:] != v[:-1])])) if len(t) else np.zeros(0, np.int64)
        self.segment_start, self.segment_end = first, np.append(first[1:], len(t)).astype(np.int64)[: len(first)]
        self.segment_level = v[first]
        self.segments = np.searchsorted(t[first], np.arange(n_terms + 1))
        self.total = np.zeros(len(ids), np.int32)

    def top(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all documents that can be among the k best, or reach ``floor``, exactly scored."""
        lists = [(self.segment_level[s], s, n) for n, t in enumerate(terms.tolist()) for s in range(self.segments[t], self.segments[t + 1])]
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists.sort(key=lambda x: (-x[0], x[1]))
        m = len(terms)
        bound = [int(self.segment_level[self.segments[t]]) if self.segments[t + 1] > self.segments[t] else 0 for t in terms.tolist()]
        last = [int(self.segments[t + 1]) for t in terms.tolist()]
        rest = sum(bound)
        total, seen = self.total, []  # rows are noted when first met, so time and resetting go by postings, not by documents
        work = sum(int(self.segment_end[s] - self.segment_start[s]) for _, s, _ in lists)
        done, check = 0, work // 16
        least = -(-floor // self.step) if floor else 0

        def proved() -> tuple[np.ndarray, np.ndarray, int]:
            """(rows met, their levels, a level below which no result lies)."""
            rows = np.concatenate(seen)
            values = total[rows]
            kth = int(np.partition(values, -k)[-k]) - m if len(rows) >= k else 0
            # levels of floor are rounded up: an upper bound of less than least - 1 is below it
            return rows, values, max(kth, least - 1)

        for level, s, n in lists:
            own = self.by_row[self.segment_start[s] : self.segment_end[s]]
            seen.append(own[total[own] == 0])
            total[own] += level
            now = int(self.segment_level[s + 1]) if s + 1 < last[n] else 0
            rest += now - bound[n]
            bound[n] = now
            done += len(own)
            if done >= check:
                check = done + max(1, work // 16)
                _, values, proof = proved()
                if rest < proof and (values + rest >= proof).sum() <= 8 * k:
                    break
        # stopped, no row unmet can reach the proof; at the end, none has any posting
        met, values, proof = proved()
        rows = np.sort(met[values + rest >= proof])
        total[met] = 0
        score = np.zeros(len(rows), np.int64)
        for t in terms.tolist():
            a, z = self.splits[t], self.splits[t + 1]
            if z > a:
                at = np.minimum(np.searchsorted(self.row[a:z], rows), z - a - 1)
                score += np.where(self.row[a:z][at] == rows, self.impact[a:z][at], 0)
        good = score > 0
        return rows[good], score[good]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def impacts(idf: np.ndarray, count: np.ndarray, words: np.ndarray, mean: float) -> np.ndarray:
    """BM25 of one term in one document, in millionths."""
    return np.floor(idf * count * (K1 + 1) / (count + K1 * ((1 - B) + B * words / mean)) * SCALE + 0.5).astype(np.int64)


def _statistics(texts: DataFrame, q: Queries) -> tuple[int, float, np.ndarray]:
    """(documents with words, mean words, documents of each term), over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, words = np.zeros(len(q.terms), np.int64), 0, 0
        for batch in batches:
            for _, _, _, term, _, length in postings(q, batch.column(1)):
                df += np.bincount(term, minlength=len(df))
                n += int((length > 0).sum())
                words += int(length.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some]).astype(np.int64)), pa.array(np.concatenate([[n, words], df[some]]).astype(np.int64))], names=["term", "n"])

    got = {r["term"]: r["n"] for r in texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    df = np.zeros(len(q.terms), np.int64)
    for t, n in got.items():
        if t >= 0:
            df[t] = n
    n = got.get(-2, 0)
    return n, got.get(-1, 0) / max(1, n), df


def _found(texts: DataFrame, q: Queries, k: int) -> DataFrame:
    """(query_id, query_row, doc_id, score in millionths) of each task's best."""
    n, mean, df = _statistics(texts, q)
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    sent = texts.sparkSession.sparkContext.broadcast((q, idf, mean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, idf, mean = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in q.of]
        held: list[tuple[np.ndarray, ...]] = []
        size = base = 0

        def flush() -> None:
            nonlocal held, size, base
            if size:
                ids, row, term, impact = (np.concatenate([h[x] for h in held]) for x in range(4))
                index = Index(ids, row, term, impact, len(q.terms))
                for x, terms in enumerate(q.of):
                    own, score = best[x]
                    rows, new = index.top(terms, k, int(score[-1]) if len(score) >= k else 0)
                    best[x] = _best(np.concatenate([own, index.ids[rows]]), np.concatenate([score, new]), k)
            held, size, base = [], 0, 0

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, row, term, count, words in postings(q, batch.column(1)):
                held.append((ids[i:j], row + base, term, impacts(idf[term], count, words[row], mean)))
                base += j - i
                size += len(row)
                if size >= POSTINGS:
                    flush()
        flush()
        many = [len(b[0]) for b in best]
        if sum(many):
            row = np.repeat(np.arange(len(best)), many)
            yield pa.RecordBatch.from_arrays([pa.array(q.ids[row]), pa.array(row.astype(np.int64)), pa.array(np.concatenate([b[0] for b in best])), pa.array(np.concatenate([b[1] for b in best]))], names=["query_id", "query_row", "doc_id", "score"])

    return texts.mapInArrow(run, "query_id long, query_row long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, key: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank from 1, doc_id, score)."""
    texts = keyed(docs).where("doc_id is not null and text is not null")
    wanted = queries.select(queries[key].cast("long").alias("query_id"), queries["text"].cast("string").alias("text")).where("query_id is not null and text is not null")
    wanted = cut(wanted)
    parts = max(1, -(-(wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    numbered = wanted.withColumn("part", F.pmod(F.xxhash64("query_id", "text"), F.lit(parts)))
    out = None
    for part in range(parts):
        rows = [(r[0], r[1]) for r in numbered.where(F.col("part") == part).orderBy("query_id", "text").select("query_id", "text").collect()]
        got = _found(texts, queries_of(rows), k).withColumn("part", F.lit(part)) if rows else None
        out = got if out is None else out.unionByName(got)
    if out is None:
        return docs.sparkSession.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "part", "query_row").orderBy(F.desc("score"), "doc_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", (F.col("score") / SCALE).alias("score"))
