"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact weighted-shingle similarity.

``matches(docs, items)`` gives (doc_id, item_id, start_word, n_words, similarity) of
the best window for each document and item whose weighted shingle similarity is
``threshold`` or more. ``clean(docs, items)`` gives the rows of docs without a match.

Shingles are word trigrams (a text of fewer words is one shingle). A shingle's
weight is ln(1 + items / items that have it). Similarity of a window and an item is
the weight of the shingles both have over that of those either has; shingles that no
item has weigh ``ln(1 + items)``. All items are searched. Of an item of fewer than ``whole_below``
words, which a sentence of other meaning may share most shingles with, all shingles must be there: its threshold is 1.

How. One Arrow pass over the documents, no shuffle. Windows have an item's number
of words (a shorter document is one window) and start at every word. (1) Windows that can't reach the threshold go: the
similarity is at most the weight of the item's shingles in the window over the item's weight. That is a proof, so no window
is lost by it. (2) Each other window gets a 64-bit SimHash of its distinct shingles, by running sums. It is cut into eight
blocks of 8 bits: two fingerprints within ``radius`` bits have some block within
radius // 8, so probing all variants of each block within that finds all items in
the radius. (3) Where some window is within an item's radius, the exact similarity of all windows is taken. So an item is missed only if none of
its overlapping windows is within the radius, though one reaches the threshold.

The index of the items is sent to executors in runs of about ``block_bytes`` of text, each
a pass over the documents, so what is sent at once doesn't grow with the benchmark (an item longer than that is sent whole).

Defined cases. Null and empty texts, texts without words, and null item texts or ids, match nothing. Very long texts are searched whole.
Repeated rows of a doc_id or item_id count once: the best window over
them. Ties: among windows of equal similarity the first is given. Null doc_id: reported
never, and kept by ``clean``. Empty tables of documents or items give no matches, and ``clean`` keeps all. Only doc_id, item_id and text are
read, so other columns can't clash; ``clean`` returns them as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .util import cut, keyed, map_batches, sized

N, THRESHOLD, RADIUS, WHOLE_BELOW, BLOCK_BYTES = 3, 0.5, 23, 8, 4 << 20
BLOCKS, BITS = 8, 8
EPS = 1e-9


@dataclass
class Index:
    ids: np.ndarray  # item_id
    words: np.ndarray  # words of each item
    weight: np.ndarray  # weight of each item's distinct shingles
    shingles: np.ndarray  # sorted, of all items
    value: np.ndarray  # their weights
    filter: np.ndarray  # bitmap over the low bits of shingles
    sets: np.ndarray  # item shingles as indexes into shingles, by item
    splits: np.ndarray
    post: np.ndarray  # items of each shingle
    post_splits: np.ndarray
    prints: np.ndarray  # SimHash by item
    keys: np.ndarray  # sorted block keys: block << 16 | bits
    owners: np.ndarray  # item of each key
    default: float  # weight of a shingle of no item


def _bits(h: np.ndarray) -> np.ndarray:
    """(n, 64) of +1 and -1."""
    h = np.ascontiguousarray(K.mix(h))
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int8) * 2 - 1


def simhash(hashes: np.ndarray, weights: np.ndarray) -> int:
    """Of one set of shingles."""
    total = (_bits(hashes) * weights[:, None]).sum(axis=0)
    return int(np.packbits(total > 0, bitorder="little").view(np.uint64)[0])


def build(rows: list[tuple[int, str]], n: int = N, total: int | None = None, among: dict[int, int] | None = None) -> Index | None:
    """The index of some items; ``total`` and ``among`` are the number of all items with words and of those that have each shingle, where there are more."""
    raw, offsets = K.buffers(pa.array([t for _, t in rows], pa.string()))
    words = K.words(raw, offsets)
    counts = np.diff(words.splits)
    sets, splits = K.distinct(*K.ngrams(words, n))
    keep = np.flatnonzero(counts > 0)
    if not len(keep):
        return None
    lists = [sets[splits[i] : splits[i + 1]] for i in keep]
    shingles, place, many = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    total = len(keep) if total is None else total
    if among is not None:
        many = np.array([among[h] for h in shingles.view(np.int64).tolist()], np.int64)
    value = np.log1p(total / many)
    new = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    by = np.argsort(place, kind="stable")
    bitmap = np.zeros(1 << 22, dtype=bool)
    bitmap[shingles & np.uint64((1 << 22) - 1)] = True
    prints = np.array([simhash(x, value[place[new[i] : new[i + 1]]]) for i, x in enumerate(lists)], np.uint64)
    blocks = np.concatenate([(np.uint64(b << BITS) | ((prints >> np.uint64(BITS * b)) & np.uint64((1 << BITS) - 1))) for b in range(BLOCKS)])
    order = np.argsort(blocks, kind="stable")
    owner = np.repeat(np.arange(len(keep)), np.diff(new))
    return Index(np.array([rows[i][0] for i in keep], np.int64), counts[keep], K.reduce_rows(np.add, value[place], new, 0.0), shingles, value, bitmap, place, new, owner[by], np.searchsorted(place[by], np.arange(len(shingles) + 1)), prints, blocks[order], np.tile(np.arange(len(keep)), BLOCKS)[order], float(np.log1p(total)))


def variants(radius: int) -> np.ndarray:
    """All masks of a block of up to radius // BLOCKS bits."""
    return np.array([sum(1 << b for b in c) for k in range(radius // BLOCKS + 1) for c in combinations(range(BITS), k)], np.uint64)


def within(index: Index, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) of all fingerprints within the radius of each other; every one is found."""
    masks = variants(radius)
    found = []
    for a in range(0, len(prints), 512):
        part = prints[a : a + 512]
        for b in range(BLOCKS):
            probe = (np.uint64(b << BITS) | (((part >> np.uint64(BITS * b)) & np.uint64((1 << BITS) - 1))[:, None] ^ masks[None, :])).reshape(-1)
            lo, hi = np.searchsorted(index.keys, probe, "left"), np.searchsorted(index.keys, probe, "right")
            some = np.flatnonzero(hi > lo)
            many = hi[some] - lo[some]
            at = np.repeat(lo[some] - np.cumsum(many) + many, many) + np.arange(many.sum())
            window, item = np.repeat(some // len(masks), many), index.owners[at]
            near = np.bitwise_count(part[window] ^ index.prints[item]) <= radius
            found.append((window[near] + a) * len(index.ids) + item[near])
    both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return both // len(index.ids), both % len(index.ids)


def _short(w: K.Words, m: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, splits by row) of all runs of m words, m < n, hashed as a text of just these words is."""
    many = np.maximum(np.diff(w.splits) - m + 1, 0)
    splits = np.concatenate([[0], np.cumsum(many)])
    first = np.repeat(w.splits[:-1] - splits[:-1], many) + np.arange(splits[-1])
    total = np.zeros(len(first), np.uint64)
    for k in range(n):
        total = K.mix(total * np.uint64(0xD1342543DE82EF95) + (w.hash[first + k] if k < m else np.uint64(0)) + np.uint64(k + 1))
    return total, splits


class _Row:
    """A document's shingles, for sums over the distinct ones of each window."""

    def __init__(self, index: Index, grams: np.ndarray):
        self.grams, m = grams, len(grams)
        order = np.argsort(grams, kind="stable")
        again = np.flatnonzero(grams[order[1:]] == grams[order[:-1]]) + 1
        self.before = np.full(m, -1)  # place of the same shingle before
        self.before[order[again]] = order[again - 1]
        self.at = np.minimum(np.searchsorted(index.shingles, grams), len(index.shingles) - 1)
        self.known = index.shingles[self.at] == grams
        self.weight = np.where(self.known, index.value[self.at], index.default)
        self.totals: dict[int, np.ndarray] = {}

    def summed(self, values: np.ndarray, z: int) -> np.ndarray:
        """Over windows of z shingles by start: the sum of values of the distinct shingles in it. values has a row for each place."""
        place = np.arange(len(values))
        change = np.zeros((len(values) + 1, *values.shape[1:]))
        np.add.at(change, np.maximum(self.before + 1, place - z + 1).clip(0), values)
        change[1:] -= values  # a shingle is in no window that starts after it
        return np.cumsum(change, axis=0)[: len(values) - z + 1]

    def total(self, z: int) -> np.ndarray:
        if z not in self.totals:
            self.totals[z] = self.summed(self.weight, z)
        return self.totals[z]

    def prints(self, starts: np.ndarray, z: int) -> np.ndarray:
        """SimHash of the windows at ``starts``, which are sorted, over the stretch they span."""
        a, b = int(starts[0]), int(starts[-1]) + z
        part = _Row.__new__(_Row)
        part.before = np.maximum(self.before[a:b] - a, -1)
        sums = part.summed(_bits(self.grams[a:b]) * self.weight[a:b, None], z)[starts - a]
        return np.ascontiguousarray(np.packbits(sums > 0, axis=1, bitorder="little")).view(np.uint64)[:, 0]


def search(index: Index, column: pa.Array, n: int, threshold: float, radius: int, whole_below: int = WHOLE_BELOW) -> list[tuple[int, int, int, int, float]]:
    """(row, item, first word, words, similarity): the best window of each row and item."""
    raw, offsets = K.buffers(column)
    out: list[tuple[int, int, int, int, float]] = []
    items = len(index.ids)
    least = np.where(index.words < whole_below, 1.0, threshold)
    for i, _, part, off in K.slices(raw, offsets):
        words = K.words(part, off)
        for m in [n, *sorted({int(x) for x in index.words if x < n})]:
            grams, splits = K.ngrams(words, n) if m == n else _short(words, m, n)
            hit = np.flatnonzero(index.filter[grams & np.uint64((1 << 22) - 1)])
            at = np.minimum(np.searchsorted(index.shingles, grams[hit]), len(index.shingles) - 1)
            good = index.shingles[at] == grams[hit]
            hit, at = hit[good], at[good]
            many = index.post_splits[at + 1] - index.post_splits[at]
            item = index.post[np.repeat(index.post_splits[at] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            fits = index.words[item] >= n if m == n else index.words[item] == m
            item, hit, at = item[fits], np.repeat(hit, many)[fits], np.repeat(at, many)[fits]
            if not len(hit):
                continue
            row = np.searchsorted(splits, hit, side="right") - 1
            pair = row * items + item
            if m < n:  # the window is the item
                pairs, first = np.unique(pair, return_index=True)
                out += [(i + p // items, p % items, int(hit[f] - splits[p // items]), m, 1.0) for p, f in zip(pairs.tolist(), first.tolist())]
                continue
            _, first = np.unique(pair * len(index.shingles) + at, return_index=True)
            pairs, back = np.unique(pair[first], return_inverse=True)
            possible = pairs[np.bincount(back, weights=index.value[at[first]]) >= (least * index.weight)[pairs % items] - EPS]
            out += [(i + r, k, s, min(int(index.words[k]), int(words.splits[r + 1] - words.splits[r])), score) for r, k, s, score in _best(index, grams, splits, possible, least, n, radius)]
    return out


def _best(index: Index, grams: np.ndarray, splits: np.ndarray, pairs: np.ndarray, least: np.ndarray, n: int, radius: int) -> list[tuple[int, int, int, float]]:
    """(row, item, start, similarity) of the pairs (row x items + item), sorted, that match."""
    items, rows, held, prints = len(index.ids), {}, [], []
    for p in pairs.tolist():
        r, k = divmod(p, items)
        if r not in rows:
            rows = {r: _Row(index, grams[splits[r] : splits[r + 1]])}
        row = rows[r]
        z = min(max(1, int(index.words[k]) - n + 1), len(row.grams))
        own = row.known & np.isin(row.at, index.sets[index.splits[k] : index.splits[k + 1]])
        both = row.summed(row.weight * own, z)
        starts = np.flatnonzero(both >= least[k] * index.weight[k] - EPS)
        if len(starts):
            scores = np.round(both[starts] / (row.total(z)[starts] + index.weight[k] - both[starts]), 6)
            top = int(np.argmax(scores))
            if scores[top] >= least[k]:
                held.append((r, k, int(starts[top]), float(scores[top])))
                prints.append(row.prints(starts, z))
    if not held:
        return []
    of = np.repeat(np.arange(len(held)), [len(x) for x in prints])
    distinct, back = np.unique(np.concatenate(prints), return_inverse=True)
    window, found = within(index, distinct, radius)
    near = set((window * items + found).tolist())
    seen = {h for h, b in zip(of.tolist(), back.reshape(-1).tolist()) if b * items + held[h][1] in near}
    return [held[h] for h in sorted(seen)]


def _frequencies(items: DataFrame, n: int) -> DataFrame:
    """(part, shingle, first) of the distinct shingles of each item; first marks one row an item."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = K.buffers(batch.column(1))
        sets, splits = K.distinct(*K.ngrams(K.words(raw, offsets), n))
        row = np.repeat(np.arange(len(splits) - 1), np.diff(splits))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(sets.view(np.int64)), pa.array(np.arange(len(row)) == splits[row])], names=["part", "shingle", "first"])

    return map_batches(items.select("part", "text"), "part long, shingle long, first boolean", one)


def matches(docs: DataFrame, items: DataFrame, n: int = N, threshold: float = THRESHOLD, radius: int = RADIUS, block_bytes: int = BLOCK_BYTES, whole_below: int = WHOLE_BELOW) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity rounded to 6 places)."""
    spark = docs.sparkSession
    texts = keyed(docs).where("doc_id is not null and text is not null")
    wanted = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    wanted = cut(wanted)
    parts = max(1, -(-(wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    numbered = wanted.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    total = among = None
    if parts > 1:  # weights are those of all items together
        seen = cut(_frequencies(numbered, n))
        total = seen.where("first").count()
        counts = cut(seen.groupBy("shingle").agg(F.count("*").alias("many")))
    schema = "doc_id long, item_id long, start_word int, n_words int, similarity double"
    out = None
    for part in range(parts):
        if parts > 1:
            among = {r[0]: r[1] for r in counts.join(seen.where(F.col("part") == part).select("shingle").distinct(), "shingle").collect()}
        index = build([(r[0], r[1]) for r in numbered.where(F.col("part") == part).orderBy("item_id", "text").select("item_id", "text").collect()], n, total, among)
        if index is None:
            continue
        sent = spark.sparkContext.broadcast(index)

        def one(batch: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            found = search(sent.value, batch.column(1), n, threshold, radius, whole_below)
            rows = pa.array([f[0] for f in found], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array([int(sent.value.ids[f[1]]) for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int32()), pa.array([f[3] for f in found], pa.int32()), pa.array([f[4] for f in found], pa.float64())], names=["doc_id", "item_id", "start_word", "n_words", "similarity"])

        got = map_batches(texts, schema, one)
        out = got if out is None else out.unionByName(got)
    if out is None:
        return spark.createDataFrame([], schema)
    best = F.row_number().over(Window.partitionBy("doc_id", "item_id").orderBy(F.desc("similarity"), "start_word", "n_words"))
    return out.withColumn("best", best).where("best = 1").drop("best")


def clean(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows of docs, all columns, whose text holds no item."""
    found = cut(matches(docs, items, **how).select(F.col("doc_id").alias("__hit")).distinct())
    return docs.join(sized(found, 16), docs["doc_id"].cast("long") == found["__hit"], "left_anti")
