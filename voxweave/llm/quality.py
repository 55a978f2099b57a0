"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

``train(docs, labels)`` gives a model; ``score(docs, model)`` gives (doc_id, score,
high_quality) of every row.

Words are runs of letters and digits, folded, and runs of other signs that aren't blank, so "price!! $$$" has the words price, !! and
$$$. Features: n-grams of one to ``n`` words, hashed
to 2^bits buckets. A bucket's value is the root of its count, scaled so that the squares
of a text's values sum to 1. Training is FTRL-proximal with per-coordinate rates, one
example at a time in order of a hash, ``epochs`` times over, each class with the same weight in all; L1 leaves most weights zero.
A score is the logistic of one sparse dot product, computed for many rows at once.

Training uses a bounded sample: about ``sample_rows`` labelled documents, chosen by a hash
of doc_id. Labels of the sample are sent to the documents, features are made where the
documents are, and one task makes the updates. The bound is a parameter; scoring covers all.

Defined cases. Null, empty and blank texts: score 0, not of high quality. Very long texts are scored whole. Labels that
are null or whose document is missing don't train; repeated rows of labels or documents
count as often as they occur. Without any labelled text, as with an empty table of labels, every weight is zero, and so every
score with words 0.5; an empty table of documents gives no rows. Ties: scores at the threshold count as high quality; examples of equal hash train in order of doc_id, label and
features. Only doc_id, text and the label are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .util import keyed, map_batches

N, BITS, SAMPLE_ROWS, EPOCHS, THRESHOLD = 2, 18, 8_000, 4, 0.5
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.2, 0.1


@dataclass
class Model:
    bits: int
    weights: np.ndarray  # float32
    bias: float
    n: int = N


_BLANK = np.zeros(256, dtype=bool)
_BLANK[:33] = _BLANK[127] = True


def tokens(raw: np.ndarray, offsets: np.ndarray) -> K.Words:
    """Words and runs of signs."""
    kind = np.where(K.word_mask(raw), 1, np.where(_BLANK[raw], 0, 2)).astype(np.int8)
    edge = np.ones(len(raw) + 1, dtype=bool)
    if len(raw):
        edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True  # a word can't go on into the next row
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    some = kind[starts] > 0
    starts, ends = starts[some], ends[some]
    return K.Words(starts, ends, K.span_hashes(K.fold_bytes(raw), starts, ends), np.searchsorted(starts, offsets))


def features(column: pa.Array, bits: int, n: int = N) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, distinct buckets, their values, splits) of slices of rows."""
    raw, offsets = K.buffers(column)
    for i, j, part, off in K.slices(raw, offsets):
        w = tokens(part, off)
        row = np.repeat(np.arange(j - i), np.diff(w.splits))
        grams, every, rows = w.hash, [w.hash], [row]
        for k in range(1, n):
            grams = K.mix(grams[:-1] * np.uint64(0xD1342543DE82EF95) + w.hash[k:])  # of k + 1 words, by the first
            inner = row[: len(grams)] == row[k:]
            every.append(grams[inner])
            rows.append(row[: len(grams)][inner])
        buckets, rows = np.concatenate(every) >> np.uint64(64 - bits), np.concatenate(rows)
        keys, many = np.unique((rows.astype(np.int64) << bits) | buckets.astype(np.int64), return_counts=True)
        splits = np.searchsorted(keys, np.arange(j - i + 1, dtype=np.int64) << bits)
        total = K.reduce_rows(np.add, many.astype(np.float64), splits, 1.0)
        yield i, j, keys & ((1 << bits) - 1), np.sqrt(many / total[keys >> bits]), splits


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], targets: list[int], bits: int = BITS, n_words: int = N, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Model:
    """FTRL-proximal over the examples, in order; the last coordinate is the bias. Examples of a class weigh len(targets) / 2 together."""
    ones = sum(targets)
    share = (len(targets) / 2 / max(1, len(targets) - ones), len(targets) / 2 / max(1, ones))
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weigh(at: np.ndarray | slice) -> np.ndarray:
        a, b = z[at], n[at]
        return np.where(np.abs(a) <= l1, 0.0, -(a - np.sign(a) * l1) / ((beta + np.sqrt(b)) / alpha + l2))

    for _ in range(epochs):
        for (buckets, values), y in zip(rows, targets):
            at = np.append(buckets, size - 1)
            x = np.append(values, 1.0)
            w = weigh(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x * share[y]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weigh(slice(None))
    return Model(bits, w[:-1].astype(np.float32), float(w[-1]), n_words)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, bits: int = BITS, epochs: int = EPOCHS, n: int = N) -> Model:
    known = labels.select(labels["doc_id"].cast("long").alias("label_id"), labels[label].cast("int").alias("y")).where("label_id is not null and y is not null")
    share = min(1.0, sample_rows / max(1, known.count()))
    order = F.xxhash64("label_id")
    drawn = F.broadcast(known.where(F.pmod(order, F.lit(1 << 30)) < share * (1 << 30)))  # about sample_rows rows, whatever the table's size
    texts = keyed(docs)
    rows = texts.join(drawn, texts["doc_id"] == drawn["label_id"]).select("doc_id", "y", "text")

    def made(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, sizes, counts = [], [], []
        for _, _, buckets, values, splits in features(batch.column(2), bits, n):
            parts.append(buckets.astype(np.int32))
            sizes.append(values.astype(np.float32))
            counts.append(np.diff(splits))
        splits = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32) if counts else np.zeros(1, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(splits), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)))
        values = pa.ListArray.from_arrays(pa.array(splits), pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.float32)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, values], names=["doc_id", "y", "buckets", "values"])

    examples = map_batches(rows, "doc_id long, y int, buckets array<int>, values array<float>", made)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys = [], []
        for batch in batches:
            lists = batch.column(2)
            flat, values, off = lists.values.to_numpy(), batch.column(3).values.to_numpy(), lists.offsets.to_numpy()
            xs += [(flat[off[k] : off[k + 1]].copy(), values[off[k] : off[k + 1]].astype(np.float64)) for k in range(len(batch))]
            ys += batch.column(1).to_pylist()
        model = ftrl(xs, ys, bits, n, epochs)
        at = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_arrays([pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([model.weights[at].tobytes()], pa.binary()), pa.array([model.bias])], names=["at", "weights", "bias"])

    one = examples.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(1)), "doc_id", "y", "buckets").mapInArrow(fit, "at binary, weights binary, bias double").collect()
    weights = np.zeros(1 << bits, np.float32)
    if not one:
        return Model(bits, weights, 0.0, n)
    weights[np.frombuffer(one[0]["at"], np.int32)] = np.frombuffer(one[0]["weights"], np.float32)
    return Model(bits, weights, one[0]["bias"], n)


def scores(model: Model, column: pa.Array) -> np.ndarray:
    """The logistic of each row's dot product; 0 without words."""
    out = np.zeros(len(column))
    for i, j, buckets, values, splits in features(column, model.bits, model.n):
        total = K.reduce_rows(np.add, model.weights[buckets] * values, splits, 0.0)
        out[i:j] = np.where(np.diff(splits) > 0, 1 / (1 + np.exp(-np.clip(total + model.bias, -35, 35))), 0.0)
    return out


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score rounded to 6 places, high_quality)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = np.round(scores(sent.value, batch.column(1)), 6)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold) & (s > 0))], names=["doc_id", "score", "high_quality"])

    return map_batches(keyed(docs), "doc_id long, score double, high_quality boolean", one)
