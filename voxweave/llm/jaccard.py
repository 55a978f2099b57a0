"""N-gram Jaccard join by MinHash banding, with exact verification.

``join(df)`` gives (doc_id, class_id, links) of every document: links is the number of other documents whose
sets of word n-grams have a Jaccard similarity of ``threshold`` or more with its own, copies included; class_id is the
lowest doc_id among the documents that chains of such links reach from it. ``one_of_each(df)`` gives the rows of df that
stay when of each class the document with the lowest doc_id stays.

How. (1) One Arrow pass hashes each text to its number of distinct n-grams, a 128-bit digest of that set, and ``bands``
band hashes of ``rows`` minima each; bands and rows are the cheapest for which a pair at the threshold shares a band
with probability ``recall``. (2) Documents of equal digest are one set, counted, of which the lowest doc_id goes on;
no list of ids is made. (3) A shuffle on band hashes counts each bucket and finds its lowest member. Members within a distance of
BALL of it are one ball, of which the lowest is the home: a group of m near copies takes m verifications, not m^2. What it links has
one label from then on, and pairs within a label aren't compared: they are a group anyhow. (4) Homes that share a bucket and not a label are
candidates; each first tries TRIES of the bucket's main label. Buckets with at most BUCKET homes outside their main label are joined with those. Homes of others
are split by n-gram: any pair at the threshold shares one among the rarest of each, so strangers whom only a common passage
brought together part without being compared, and nobody is lost. Groups that are still large are paired in blocks. All candidates are
verified on full sets by a shuffle; those stay that are so near that members of their balls may be linked. (5) What they join is
the groups within which every link must lie. Sets are sent once to their group and all pairs settled there: Jaccard distance is a
metric, so most pairs of near copies are settled by their distances to one of them, and the others are counted on full sets. A group of more than
CELL n-grams is cut to blocks by distance to its lowest member, of which each pair not settled by distance is a task. No cap on buckets,
partners or groups; nothing is broadcast but sieves of ids (of a fixed size, so that texts of others aren't shuffled), the n-grams that more than one in FREQUENT of those looked at are (at most FREQUENT),
and classes that hold more than one in HOT of all documents (at most HOT).

Defined cases. Null and empty texts, and texts without words, have no n-grams, no links, and are a class by themselves. A text
of fewer than n words is one n-gram of them all. Very long texts are sets like others; one that is longer than CELL is a block by itself.
Rows that repeat a doc_id count once for ``join`` (the first text in order of its digest, one with words first); in
``one_of_each`` rows of a doc_id stay or go together. Rows of null doc_id are left out by ``join`` and stay in ``one_of_each``. Ties don't arise: the
lowest doc_id names the class. An empty table gives no rows. Only doc_id and text are read, so other columns can't clash; ``one_of_each``
returns them as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .util import cut, keyed, map_batches, sieve, sifted, small_batches

N, THRESHOLD, RECALL = 3, 0.6, 0.995
ROWS = 3
BALL, BUCKET, BLOCK, CELL, STEP = 0.1, 32, 512, 1 << 18, 0.05
FREQUENT, HOT, TRIES = 500_000, 10_000, 1
EPS = 1e-9


def plan(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> tuple[int, int]:
    """(bands, rows): the fewest bands of ``rows`` minima with 1 - (1 - threshold^rows)^bands >= recall."""
    return max(1, int(np.ceil(np.log1p(-recall) / np.log1p(-(threshold**rows))))), rows


def _odd(k: int) -> np.ndarray:
    return K.mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def row_sets(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, distinct n-grams, their splits) of slices of rows."""
    raw, offsets = K.buffers(column)
    for i, j, part, off in K.slices(raw, offsets):
        yield i, j, *K.distinct(*K.ngrams(K.words(part, off), n))


def digests(sets: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each row's set."""
    a = K.reduce_rows(np.add, K.mix(sets + np.uint64(0x51ED27)), splits, 0)
    return a.view(np.int64), K.reduce_rows(np.add, K.mix(sets ^ np.uint64(0xA5A5A5A5DEADBEEF)), splits, 0).view(np.int64)


def signatures(df: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, size, digest_a, digest_b, bands array<long>) of the rows with a doc_id; without words size is 0 and bands are empty. A band's number is part of its hash."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = len(batch)
        size, a, b = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
        band = np.zeros((m, bands), np.uint64)
        odd = _odd(bands * rows)
        for i, j, sets, splits in row_sets(batch.column(1), n):
            size[i:j] = np.diff(splits)
            a[i:j], b[i:j] = digests(sets, splits)
            for k in range(bands):
                total = np.full(j - i, k + 1, np.uint64)
                for r in range(rows):
                    total = K.mix(total * np.uint64(31) + K.reduce_rows(np.minimum, sets * odd[k * rows + r], splits, 0))
                band[i:j, k] = total
        keep = np.flatnonzero(np.asarray(batch.column(0).is_valid()))
        some = size[keep] > 0
        splits = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(splits), pa.array(band[keep[some]].reshape(-1).view(np.int64)))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(size[keep]), pa.array(a[keep]), pa.array(b[keep]), lists], names=["doc_id", "size", "digest_a", "digest_b", "bands"])

    return map_batches(keyed(df), "doc_id long, size long, digest_a long, digest_b long, bands array<long>", one)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of undirected edges (u, v), u > v; label is the lowest node of the component. Large-star and small-star steps until nothing changes."""

    def unfinished(e: DataFrame) -> bool:
        """Whether some node has two links, or links to a node that links on."""
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        seen = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        return bool(seen.agg(F.max((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0)))).first()[0])

    edges = cut(edges.select("u", "v").distinct())
    while unfinished(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = edges.join(least.select(F.col("u").alias("v"), "m"), "v").select("u", F.col("m").alias("v")).where("u <> v")
        large = large.unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = cut(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _grams(df: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(rep, grams) of the wanted (rep, digest_a, digest_b), from the texts; of several texts of a doc_id, the one of that digest, once."""
    texts = sifted(keyed(df), "doc_id", sieve(wanted.select("rep"))).where("__may").drop("__may")  # so that few other texts are shuffled
    texts = texts.join(wanted.select("rep", "digest_a", "digest_b"), texts["doc_id"] == wanted["rep"]).select("rep", "text", "digest_a", "digest_b")

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, counts, a, b = [], [], [], []
        for _, _, sets, splits in row_sets(batch.column(1), n):
            parts.append(sets)
            counts.append(np.diff(splits))
            x, y = digests(sets, splits)
            a.append(x)
            b.append(y)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        splits = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1)
        lists = pa.ListArray.from_arrays(pa.array(splits.astype(np.int32)), pa.array(flat.view(np.int64)))
        out = pa.RecordBatch.from_arrays([batch.column(0), lists], names=["rep", "grams"])
        same = (np.concatenate(a) == batch.column(2).to_numpy()) & (np.concatenate(b) == batch.column(3).to_numpy()) if a else np.zeros(0, dtype=bool)
        return out if same.all() else out.filter(pa.array(same))

    return map_batches(texts, "rep long, grams array<long>", one)


def _of(grams: DataFrame, ids: DataFrame) -> DataFrame:
    """The grams of the ids (and of few others), so that the rest isn't shuffled."""
    return sifted(grams, "rep", sieve(ids)).where("__may").drop("__may")


def _verified(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """pairs (u, v, ...) with j, their exact similarity: full sets are joined by shuffle, twice on the same partitioning of the sets."""
    with_u = pairs.join(grams.select(F.col("rep").alias("u"), F.col("grams").alias("gu")), "u")
    both = with_u.join(grams.select(F.col("rep").alias("v"), F.col("grams").alias("gv")), "v")
    k = F.size(F.array_intersect("gu", "gv"))
    return both.select(*pairs.columns, (k / (F.size("gu") + F.size("gv") - k)).alias("j"))


def _sizes_fit(a: Column, b: Column, least: Column | float) -> Column:
    return F.least(a, b) >= F.greatest(a, b) * (least - EPS)


def _parted(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key is shared by several labels, with the label that most of its rows have as __main, the number __n of its rows and the number __rest of those of other labels."""
    by = rows.groupBy(key, "label").agg(F.count("*").alias("n")).groupBy(key).agg(F.sum("n").alias("__n"), F.max(F.struct("n", "label")).alias("top")).where("top.n < __n")
    return rows.join(by.select(key, "__n", (F.col("__n") - F.col("top.n")).alias("__rest"), F.col("top.label").alias("__main")), key)


def _fitting(both: DataFrame, threshold: float) -> DataFrame:
    """(u, v, need), u > v, distinct, of the pairs (id, size, ball, level and the same of the other by o_); need is the similarity below which no members of their balls are linked."""
    balls = F.col("ball").cast("int") + F.col("o_ball").cast("int")
    both = both.where(F.greatest("level", "o_level") <= balls).withColumn("need", threshold - BALL * balls)
    return both.where(_sizes_fit(F.col("size"), F.col("o_size"), F.col("need"))).select(F.greatest("id", "o_id").alias("u"), F.least("id", "o_id").alias("v"), "need").distinct()


def _other(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys, *[F.col(c).alias("o_" + c) for c in ("id", "size", "ball", "level", "label")])


def _paired(rows: DataFrame, key: str, threshold: float) -> DataFrame:
    """As ``_fitting``, of the ``_parted`` rows (key, id, size, ball, level, label) that share a key and not a label.

    Those of the main label meet only the others, so a great group costs what is outside it. Keys of more than BLOCK rows are paired in blocks, so a task's join has at most some BLOCK^2 pairs of a key, whatever its size.
    """
    blocks = lambda c: F.ceil(F.col(c) / BLOCK)
    mine = lambda c: F.pmod(F.xxhash64("id"), blocks(c))
    each = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    few = rows.where("label <> __main").withColumn("i", mine("__rest")).withColumn("j", each("__n"))
    all_ = _other(rows.withColumn("j", mine("__n")).withColumn("i", each("__rest")), key, "i", "j")
    both = few.join(all_, [key, "i", "j"]).where((F.col("label") != F.col("o_label")) & ((F.col("o_label") == F.col("__main")) | (F.col("id") > F.col("o_id"))))
    return _fitting(both, threshold)


def _tried(rows: DataFrame, k: int, threshold: float) -> DataFrame:
    """As ``_paired``, but each row meets only one row of its key's main label, drawn by a hash that ``k`` changes."""
    drawn = rows.where("label = __main").groupBy("value").agg(F.min_by(F.struct("id", "size", "ball", "level", "label"), F.xxhash64("id", F.lit(k))).alias("s")).select("value", "s.*")
    return _fitting(rows.where("label <> __main").join(_other(drawn, "value"), "value"), threshold)


def _joined(heads: DataFrame, pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """(old, new) labels that change as the heads (id, label) of pairs that are as near as they need be join."""
    label = heads.select("id", "label").distinct()
    edges = _verified(pairs, grams).where(F.col("j") >= F.col("need") - EPS)
    edges = edges.join(label.select(F.col("id").alias("u"), F.col("label").alias("a")), "u").join(label.select(F.col("id").alias("v"), F.col("label").alias("b")), "v")
    return cut(components(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))).where("node <> label").select(F.col("node").alias("old"), F.col("label").alias("new")))


def _renamed(rows: DataFrame, changed: DataFrame) -> DataFrame:
    return rows.join(changed, rows["label"] == changed["old"], "left").withColumn("label", F.coalesce("new", "label")).drop("old", "new")


def _rarest(homes: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """(gram, id, size, ball, level, label) of the homes (id, size, ball, label): the rarest n-grams of each, as many as a pair must share one of; level is the number of balls from which on a pair needs it."""
    some = _of(grams, homes.select("id"))
    own = homes.join(some, homes["id"] == some["rep"]).select("id", "size", "ball", "grams", "label")
    total = homes.agg(F.sum("size")).first()[0] or 0
    counts = own.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > max(BUCKET, total // FREQUENT))
    frequent = counts.collect()  # of n-grams that occur more than total / FREQUENT times there are at most FREQUENT
    keys = np.array([r["gram"] for r in frequent], np.int64)
    order = np.argsort(keys)
    sent = homes.sparkSession.sparkContext.broadcast((keys[order], np.array([r["n"] for r in frequent], np.int64)[order]))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, many = sent.value
        lists = batch.column(3)
        flat, size = lists.flatten().to_numpy(), batch.column(1).to_numpy()
        row = np.repeat(np.arange(len(batch)), size)
        ball = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.minimum(np.searchsorted(keys, flat), max(0, len(keys) - 1))
        rank = np.where(keys[at] == flat, many[at], 0) if len(keys) else np.zeros(len(flat), np.int64)
        by = np.lexsort((flat, rank, row))
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        level = np.full(len(flat), 3)
        for k in (2, 1, 0):
            reach = size - np.ceil(np.maximum(threshold - BALL * k, 0.01) * size - EPS).astype(np.int64) + 1
            level[place < reach[row]] = k
        keep = level <= 1 + ball[row]
        row = row[keep]
        ids = batch.column(0).take(pa.array(row))
        return pa.RecordBatch.from_arrays([pa.array(flat[by][keep]), ids, pa.array(size[row]), pa.array(ball[row] > 0), pa.array(level[keep].astype(np.int32)), batch.column(4).take(pa.array(row))], names=["gram", "id", "size", "ball", "level", "label"])

    return map_batches(own, "gram long, id long, size long, ball boolean, level int, label long", one)


class _Sets:
    """Sorted distinct n-grams of several documents, numbered, for counting what they share."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat = flat.reshape(-1).astype(np.int32)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.mark = np.zeros(int(self.flat.max(initial=-1)) + 1, np.int32)

    def own(self, k: int) -> np.ndarray:
        return self.flat[self.start[k] : self.start[k + 1]]

    def scores(self, k: int, among: np.ndarray | slice | None = None) -> np.ndarray:
        """Similarity of set k and each of the others, or of those ``among``."""
        own = self.own(k)
        self.mark[own] = 1
        if among is None:
            shared, size = np.add.reduceat(self.mark[self.flat], self.start[:-1]), self.size
        elif isinstance(among, slice):
            shared, size = np.add.reduceat(self.mark[self.flat[self.start[among.start] : self.start[among.stop]]], self.start[among] - self.start[among.start]), self.size[among]
        else:
            size = self.size[among]
            at = np.repeat(self.start[among] - np.cumsum(size) + size, size) + np.arange(size.sum())
            shared = np.add.reduceat(self.mark[self.flat[at]], np.cumsum(size) - size)
        self.mark[own] = 0
        return shared / (self.size[k] + size - shared)


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _unite(parent: list[int], x: int, others: np.ndarray) -> None:
    for y in others.tolist():
        a, b = _find(parent, x), _find(parent, y)
        if a != b:
            parent[max(a, b)] = min(a, b)


def settled(sets: list[np.ndarray], copies: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(first, links): for each set the first that chains of links reach, and the copies of all other sets at the threshold or above.

    A leader's distances to all are taken; sets within half of the greatest linked distance of it are linked with each other, and with
    a set y whose distance from the leader lies beyond theirs by more they are not. Only what lies between is compared.
    """
    m, s, near = len(sets), _Sets(sets), 1 - threshold
    links, parent, left = np.zeros(m, np.int64), list(range(m)), np.ones(m, dtype=bool)
    for leader in range(m):
        if not left[leader]:
            continue
        score = s.scores(leader)
        away = 1 - score
        linked = np.flatnonzero(score >= threshold)
        links[leader] = copies[linked].sum() - copies[leader]
        _unite(parent, leader, linked)
        core = np.flatnonzero(left & (away <= near / 2 - EPS))
        left[core] = left[leader] = False
        order = np.argsort(away, kind="stable")
        ranked, summed = away[order], np.concatenate([[0], np.cumsum(copies[order])])
        for x in core[core != leader].tolist():
            a, z = np.searchsorted(ranked, (near - EPS - away[x], near + EPS + away[x]), side="right")
            links[x] = summed[a] - copies[x]
            if z > a:
                open_ = order[a:z]
                more = open_[s.scores(x, open_) >= threshold]
                links[x] += copies[more].sum()
                _unite(parent, x, more)
    return np.array([_find(parent, x) for x in range(m)]), links


def crossed(left: list[np.ndarray], right: list[np.ndarray], copies: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """As ``settled``, of pairs of one set of left and one of right, which are numbered on; copies are of both."""
    a, m = len(left), len(left) + len(right)
    s, links, parent = _Sets([*left, *right]), np.zeros(m, np.int64), list(range(m))
    short, long = (np.arange(a), np.arange(a, m)) if a <= m - a else (np.arange(a, m), np.arange(a))
    run = slice(int(long[0]), int(long[-1]) + 1)
    for x in short.tolist():
        with_x = long[s.scores(x, run) >= threshold]
        links[x] += copies[with_x].sum()
        links[with_x] += copies[x]
        _unite(parent, x, with_x)
    return np.array([_find(parent, x) for x in range(m)]), links


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list[int], list[int], list[int], list[np.ndarray]]]:
    """(reps, copies, sides, sets) of each run of rows of equal first ``keys`` columns; then come side, rep, copies, grams."""
    at, reps, copies, sides, sets = None, [], [], [], []
    for batch in batches:
        key = list(zip(*(batch.column(k).to_pylist() for k in range(keys))))
        side, rep, many = (batch.column(keys + k).to_pylist() for k in range(3))
        lists = batch.column(keys + 3)
        flat, off = lists.values.to_numpy(), lists.offsets.to_numpy()
        for k in range(len(batch)):
            if key[k] != at and reps:
                yield reps, copies, sides, sets
                reps, copies, sides, sets = [], [], [], []
            if key[k] == at and reps and reps[-1] == rep[k]:
                continue  # a repeated row
            at = key[k]
            reps.append(rep[k])
            copies.append(many[k])
            sides.append(side[k])
            sets.append(flat[off[k] : off[k + 1]].copy())
    if reps:
        yield reps, copies, sides, sets


def _in_groups(rows: DataFrame, keys: list[str], settle: Callable) -> DataFrame:
    """(rep, root, links) of the rows (keys, side, rep, copies, grams), each group of keys in one task, which its size allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for reps, copies, sides, sets in _groups(batches, len(keys)):
            first, links = settle(sets, sides, np.array(copies, np.int64))
            ids = np.array(reps, np.int64)
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, first, ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(least[first]), pa.array(links)], names=["rep", "root", "links"])

    small_batches(rows.sparkSession)
    return rows.select(*keys, "side", "rep", "copies", "grams").repartition(*keys).sortWithinPartitions(*keys, "side", "rep").mapInArrow(run, "rep long, root long, links long")


def _in_blocks(placed: DataFrame, grams: DataFrame, threshold: float, cell: int) -> DataFrame:
    """(rep, root, links) of groups (label, rep, size, copies) too large for a task."""
    near = round((1 - threshold) / STEP)
    known = _verified(placed.where("rep <> label").select(F.col("rep").alias("u"), F.col("label").alias("v"), "size", "copies"), grams)
    own = placed.where("rep = label").select(F.col("rep").alias("u"), F.col("label").alias("v"), "size", "copies", F.lit(1.0).alias("j"))
    rows = cut(known.unionByName(own).select(F.col("v").alias("label"), F.col("u").alias("rep"), "size", "copies", "j", F.floor((1 - F.col("j")) / STEP).cast("int").alias("bin")))
    bins = cut(rows.groupBy("label", "bin").agg(F.sum("size").alias("w"), F.sum("copies").alias("c")).withColumn("parts", F.ceil(F.col("w") / cell)))
    other = bins.select("label", F.col("bin").alias("o_bin"), F.col("c").alias("o_c"), F.col("parts").alias("o_parts"))
    pairs = bins.select("label", "bin", "parts").join(other, "label")
    surely = F.col("bin") + F.col("o_bin") + 2 <= near
    sums = pairs.where(surely).groupBy("label", "bin").agg(F.sum("o_c").alias("sure"))
    open_ = pairs.where(~surely & (F.abs(F.col("bin") - F.col("o_bin")) <= near + 1))
    code = lambda b, p: F.shiftleft(b.cast("long"), 40) + p
    open_ = open_.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("o_parts") - 1))).select("label", "bin", "parts", code(F.col("o_bin"), F.col("part")).alias("there"))
    cells = rows.join(open_, ["label", "bin"]).withColumn("here", code(F.col("bin"), F.pmod(F.xxhash64("rep"), F.col("parts"))))
    cells = cells.select("label", F.least("here", "there").alias("lo"), F.greatest("here", "there").alias("hi"), (F.col("here") > F.col("there")).cast("int").alias("side"), "rep", "copies").join(grams, "rep")

    def settle(sets: list[np.ndarray], sides: list[int], copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = sides.count(0)
        if 0 < a < len(sets):
            return crossed(sets[:a], sets[a:], copies, threshold)
        return settled(sets, copies, threshold)

    # a block that meets an empty one is alone in its cell; it must not be settled with itself there
    alone = cells.groupBy("label", "lo", "hi").agg(F.min("side").alias("a"), F.max("side").alias("z")).where("lo = hi or a <> z")
    found = cut(_in_groups(cells.join(alone.select("label", "lo", "hi"), ["label", "lo", "hi"]), ["label", "lo", "hi"], settle))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = found.where("rep <> root").select(F.col("rep").alias("u"), F.col("root").alias("v")).unionByName(rows.where((F.col("j") >= threshold) & (F.col("rep") != F.col("label"))).select(F.col("rep").alias("u"), F.col("label").alias("v")))
    comps = components(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    counted = rows.join(sums, ["label", "bin"], "left").join(links, "rep", "left").join(comps.select(F.col("node").alias("rep"), F.col("label").alias("root")), "rep", "left")
    sure = F.coalesce(F.col("sure") - F.when(2 * F.col("bin") + 2 <= near, F.col("copies")).otherwise(0), F.lit(0))
    return counted.select("rep", F.coalesce("root", "rep").alias("root"), (sure + F.coalesce("links", F.lit(0))).alias("links"))


def _classes(df: DataFrame, n: int, threshold: float, recall: float, rows: int, cell: int) -> tuple[DataFrame, DataFrame]:
    """(docs, found): (doc_id, size, digests) of all documents; (digests, class_id, links, copies) of the sets that have links or copies."""
    bands, rows = plan(threshold, recall, rows)
    first = F.min(F.struct((F.col("size") == 0).alias("none"), "digest_a", "digest_b", "size", "bands")).alias("s")
    docs = cut(signatures(df, n, bands, rows).groupBy("doc_id").agg(first).select("doc_id", "s.size", "s.digest_a", "s.digest_b", "s.bands"))
    sets = cut(docs.where("size > 0").groupBy("digest_a", "digest_b", "size").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.any_value("bands").alias("bands")))
    docs = docs.drop("bands")

    # buckets of two or more, with their lowest member
    banded = sets.select("rep", F.explode("bands").alias("value"))
    buckets = banded.groupBy("value").agg(F.count("*").alias("n"), F.min("rep").alias("pivot")).where("n > 1")
    members = cut(banded.join(buckets.drop("n"), "value").select("value", "rep", "pivot"))
    involved = cut(sets.drop("bands").join(members.select("rep").distinct(), "rep", "left_semi"))
    grams = cut(_grams(df, involved, n))
    size = lambda c: involved.select(F.col("rep").alias(c), F.col("size").alias("size_" + c))

    # what a bucket's lowest member links, and balls: its near copies, unless it is near another
    least = min(threshold, 1 - BALL)
    stars = members.where("rep <> pivot").select(F.col("rep").alias("u"), F.col("pivot").alias("v")).distinct()
    stars = stars.join(size("u"), "u").join(size("v"), "v").where(_sizes_fit(F.col("size_u"), F.col("size_v"), least)).select("u", "v")
    near = cut(_verified(stars, grams).where(F.col("j") >= least - EPS))
    close = near.where(F.col("j") >= 1 - BALL + EPS).select("u", "v")
    homes = close.join(close.select(F.col("u").alias("v")).distinct(), "v", "left_anti").groupBy("u").agg(F.min("v").alias("home"))
    nodes = involved.join(homes.withColumnRenamed("u", "rep"), "rep", "left").withColumn("home", F.coalesce("home", "rep")).select("rep", "size", "copies", "home")
    balls = nodes.where("home <> rep").select("home").distinct().withColumn("ball", F.lit(True))
    nodes = nodes.join(balls, "home", "left").withColumn("ball", F.coalesce("ball", F.lit(False)))
    nodes = cut(nodes.join(components(near).withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep")))

    # homes that share a bucket and no label yet
    heads = members.select("value", "rep").join(nodes.select("rep", "home", "ball", "label"), "rep").select("value", F.col("home").alias("id"), "ball", "label").distinct()
    heads = cut(heads.join(size("id").withColumnRenamed("size_id", "size"), "id").withColumn("level", F.lit(0)))
    for k in range(TRIES):
        sharing = cut(_parted(heads, "value"))
        changed = _joined(sharing, _tried(sharing, k, threshold), grams)
        heads, nodes = cut(_renamed(heads, changed)), cut(_renamed(nodes, changed))
    sharing = cut(_parted(heads, "value"))
    pairs = _paired(sharing.where(F.col("__rest") <= BUCKET), "value", threshold)
    crowd = cut(sharing.where(F.col("__rest") > BUCKET).select("id", "size", "ball", "label").distinct())
    if not crowd.isEmpty():
        pairs = pairs.unionByName(_paired(_parted(cut(_rarest(crowd, grams, threshold)), "gram"), "gram", threshold)).distinct()
    nodes = _renamed(nodes, _joined(sharing, pairs, grams))

    # groups within which every link lies
    placed = cut(nodes.select("label", "rep", "size", "copies"))
    weights = cut(placed.groupBy("label").agg(F.sum("size").alias("w"), F.count("*").alias("n")).where("n > 1").drop("n"))
    small = cut(placed.join(weights.where(F.col("w") <= cell).select("label"), "label"))
    small = small.join(_of(grams, small.select("rep")), "rep").withColumn("side", F.lit(0))
    found = _in_groups(small, ["label"], lambda sets, _, copies: settled(sets, copies, threshold))
    if not weights.where(F.col("w") > cell).isEmpty():
        large = cut(placed.join(weights.where(F.col("w") > cell).select("label"), "label"))
        found = found.unionByName(_in_blocks(large, _of(grams, large.select("rep")), threshold, cell))
    joined = sets.drop("bands").join(found, "rep", "left").where("copies > 1 or root is not null")
    return docs, cut(joined.select("digest_a", "digest_b", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "copies"))


def join(df: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS, cell: int = CELL) -> DataFrame:
    """(doc_id, class_id, links) of every document."""
    docs, found = _classes(df, n, threshold, recall, rows, cell)
    share = docs.count() / HOT
    hot, rest = found.where(F.col("copies") > share).drop("copies"), found.where(F.col("copies") <= share).drop("copies")  # there are fewer than HOT hot ones
    key = ["digest_a", "digest_b"]
    worded = docs.where("size > 0")
    some = worded.join(F.broadcast(hot), key)
    others = worded.join(F.broadcast(hot.select(*key)), key, "left_anti").join(rest, key, "left")
    out = some.select("doc_id", "class_id", "links").unionByName(others.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links")))
    return out.unionByName(docs.where("size = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("links")))


def losers(df: DataFrame, **how) -> DataFrame:
    """(doc_id) of the documents that go: all of a class but the lowest doc_id."""
    return join(df, **how).where("doc_id <> class_id").select("doc_id")


def one_of_each(df: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """The rows of df, all columns, without the losers."""
    gone = cut(losers(df.select(df[key].alias("doc_id"), df["text"]), **how).select(F.col("doc_id").alias("__gone")))
    told = sifted(df, key, sieve(gone))
    stay = told.where("not __may").drop("__may")  # surely no losers: they aren't shuffled
    rest = told.where("__may").drop("__may")
    return stay.unionByName(rest.join(gone, rest[key].cast("long") == gone["__gone"], "left_anti"))
