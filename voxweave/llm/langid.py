"""Language ID by cross-parsing: the language whose text needs the fewest normalised phrases.

``train(df)`` takes labelled text of each language; ``identify(df, model)`` gives
(doc_id, lang, rate, margin, accepted) for every row.

A model holds, for each language, folded labelled text and its
suffix automaton. A text is parsed against it from left to right: each phrase is the
longest match of what follows anywhere in that language's text, found by walking the
automaton until it has no way on; the byte at which it stops begins the next phrase.
A byte that the language's text doesn't hold is a phrase. The rate is phrases per
byte x log2(corpus length): the cross-parsing estimate of bits per byte. The
language of the lowest rate wins, ties by name; margin is the gap to the next.

Folding: letters are lowered (ASCII and Latin-1), digits and ASCII punctuation become
spaces, runs of spaces one; other bytes stay. Texts are parsed whole, however long. Many
are walked at once, a byte of each at a step, through one dense table whose
entries hold the next state and the phrases ended; where only a few are as long as that, each of those is walked by itself.

Accepted means: some letters, and a rate, less SHORT / sqrt(bytes) as short texts vary more, within the winner's limit: MARGIN above the 0.99 quantile of that
language's held-out texts. What is rejected isn't text in any of the languages.

Training text is a bounded sample of whole rows: ``sample_rows`` distinct texts of each language in order of a hash, those of more than
LONGEST bytes after all others; the ``held_rows`` next ones are held out to set the limit. So
a language with any text is trained however often it is repeated. Both
bounds are parameters; identification covers everything.

Defined cases. Null, empty and letterless texts: lang null, rate and margin null, not
accepted. Repeated rows and null doc_id are treated row by row. An empty table gives no rows. Rows
with a null label or text don't train. A language without held-out text has the highest limit of the others; where none has any,
whatever has letters is accepted. Without any labelled text the model is empty: it names no
language, and accepts whatever has letters. Only doc_id, text and, in training, lang are read, so other columns can't clash; ``accepted`` returns them as they are.
"""

from __future__ import annotations

import hashlib
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .util import keyed, map_batches

SAMPLE_ROWS, HELD_ROWS, LONGEST, MARGIN, SHORT = 20, 200, 8192, 0.4, 15.0
LANES, FEW = 4096, 16

_SPACES = np.zeros(256, dtype=bool)
_SPACES[:97] = _SPACES[123:128] = True
_SPACES[65:91] = False


def fold(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes and offsets; a row neither begins nor ends with a space."""
    blank = _SPACES[raw]
    out = K.fold_bytes(raw)
    out[blank] = 32
    keep = ~blank
    if len(raw) > 1:
        keep[1:] |= ~blank[:-1]  # the first of a run of blanks
    heads = offsets[:-1][np.diff(offsets) > 0]
    keep[heads] &= ~blank[heads]
    if len(raw) > 1:
        # a run's first blank goes where nothing follows it in its row
        after = np.flatnonzero(~blank)
        first = np.flatnonzero(keep & blank)
        place = np.searchsorted(after, first)
        nxt = np.where(place < len(after), after[np.minimum(place, max(0, len(after) - 1))] if len(after) else 0, len(raw))
        keep[first[np.searchsorted(offsets, first, side="right") != np.searchsorted(offsets, nxt, side="right")]] = False
    count = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], count[offsets]


def fold_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``fold``, a run of rows at a time, as it works on arrays many times as large as its bytes."""
    runs = [fold(part, off) for _, _, part, off in K.slices(raw, offsets)]
    return np.concatenate([d for d, _ in runs]), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(e) for _, e in runs]))])


def automaton(symbols: list[int], table: np.ndarray) -> int:
    """Writes the transitions of the suffix automaton (online construction) to the first rows of the zeroed table, a row for each state, 0 for none as no way leads to the start; the number of states, 2 a symbol at most."""
    width, ways = table.shape[1], memoryview(table.reshape(-1))
    link, length, last, states = array("q", [-1]), array("q", [0]), 0, 1
    for c in symbols:
        cur = states
        states += 1
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and not ways[p * width + c]:
            ways[p * width + c] = cur
            p = link[p]
        if p >= 0:
            q = ways[p * width + c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = states
                states += 1
                ways[clone * width : (clone + 1) * width] = ways[q * width : (q + 1) * width]
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and ways[p * width + c] == q:
                    ways[p * width + c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return states


@dataclass
class Model:
    texts: dict[str, bytes]
    limits: dict[str, float] = field(default_factory=dict)  # rate of long texts up to which one is accepted
    langs: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.langs = sorted(k for k, t in self.texts.items() if t)

    @property
    def digest(self) -> str:
        return hashlib.sha1(repr(sorted(self.texts.items())).encode()).hexdigest()


@dataclass
class Tables:
    """Dense transitions of all languages in one array: [state x width + symbol] -> state x width << 2 | phrases ended."""

    symbol: np.ndarray  # byte -> symbol; 0 for bytes that no language has
    step: np.ndarray
    root: np.ndarray  # start of each language
    bits: np.ndarray  # log2 of each language's length


_tables: dict[str, Tables] = {}


def tables(model: Model) -> Tables:
    key = model.digest
    if key in _tables:
        return _tables[key]
    _tables.clear()  # two models' tables are never held at once
    used = sorted({c for t in model.texts.values() for c in t})
    symbol = np.zeros(256, np.int32)
    symbol[used] = np.arange(1, len(used) + 1)
    width, base, roots = len(used) + 1, 0, []
    most = sum(2 * len(model.texts[x]) + 1 for x in model.langs)
    step = np.zeros((most, width), np.int32 if most * width << 2 < 2**31 else np.int64)  # of rows that no state takes no memory is touched
    for lang in model.langs:
        n = automaton(symbol[np.frombuffer(model.texts[lang], np.uint8)].tolist(), step[base:])
        top = step[base].copy()
        # no way on: a phrase ends, and the byte begins the next one; a byte that isn't there is a phrase, and so the next starts anew
        fallback = np.where(top > 0, ((top + base) * width) << 2 | 1, (base * width) << 2 | 2)
        for a in range(base, base + n, LANES):
            some = step[a : min(a + LANES, base + n)]
            some[:] = np.where(some > 0, ((some + base) * width) << 2, fallback)
        step[base] = np.where(top > 0, ((top + base) * width) << 2, (base * width) << 2 | 1)
        roots.append(base * width)
        base += n
    _tables[key] = Tables(symbol, step[:base].reshape(-1), np.array(roots, np.int64), np.log2([len(model.texts[x]) + 1 for x in model.langs]) if model.langs else np.zeros(0))
    return _tables[key]


def phrases(t: Tables, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, languages): phrases of each row's folded bytes."""
    n, langs = len(offsets) - 1, len(t.root)
    out = np.zeros((n, langs), np.int64)
    length = np.diff(offsets)
    order = np.argsort(-length, kind="stable")[: int((length > 0).sum())]
    symbols, steps = t.symbol[data], memoryview(t.step)
    for a in range(0, len(order), LANES):
        lane = order[a : a + LANES]
        at, left = offsets[lane], length[lane]
        live = np.searchsorted(-left, -np.arange(1, left[0] + 1), side="right")  # lanes that have an s-th byte
        wide = int(np.searchsorted(-live, -FEW, side="right"))  # steps at which there are at least FEW
        state = np.repeat(t.root[:, None], len(lane), axis=1).astype(t.step.dtype)
        count = np.zeros((langs, len(lane)), np.int64)
        for s, k in enumerate(live[:wide].tolist()):
            got = t.step[state[:, :k] + symbols[at[:k] + s]]
            count[:, :k] += got & 3
            state[:, :k] = got >> 2
        for k in range(int(live[wide]) if wide < len(live) else 0):
            rest = symbols[at[k] + wide : at[k] + left[k]].tolist()
            for x in range(langs):
                now, many = int(state[x, k]), 0
                for y in rest:
                    got = steps[now + y]
                    many += got & 3
                    now = got >> 2
                state[x, k] = now
                count[x, k] += many
        # what is open at the end is a phrase
        out[lane] = (count + (state != t.root[:, None])).T
    return out


def rates(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows, languages) of bits per byte, and each row's folded length."""
    t = tables(model)
    raw, offsets = K.buffers(column)
    parts, lengths = [], []
    for _, _, part, off in K.slices(raw, offsets, 8 << 20):
        data, ends = fold_runs(part, off)
        length = np.diff(ends)
        parts.append(phrases(t, data, ends) * t.bits / np.maximum(length, 1)[:, None])
        lengths.append(length)
    return (np.concatenate(parts) if parts else np.zeros((0, len(model.langs)))), (np.concatenate(lengths) if lengths else np.zeros(0, np.int64))


def _model(drawn: dict[str, list[str]], sample_rows: int) -> Model:
    """From each language's texts in order: the first are its text, the rest set its limit."""

    def folded(texts: list[str]) -> bytes:
        data, ends = fold(*K.buffers(pa.array(texts, pa.string())))
        return b" ".join(p for a, z in zip(ends, ends[1:]) if (p := data[a:z].tobytes()))

    model = Model({lang: folded(texts[:sample_rows]) for lang, texts in drawn.items()})
    limits = {}
    for lang in model.langs:
        rate, length = rates(model, pa.array(drawn[lang][sample_rows:], pa.string()))
        if (length > 0).any():
            some = length > 0
            limits[lang] = float(np.quantile(rate[some, model.langs.index(lang)] - SHORT / np.sqrt(length[some]), 0.99)) * (1 + MARGIN)
    model.limits = {lang: limits.get(lang, max(limits.values())) for lang in model.langs} if limits else {}
    return model


def train(df: DataFrame, label: str = "lang", text: str = "text", sample_rows: int = SAMPLE_ROWS, held_rows: int = HELD_ROWS) -> Model:
    """A model from the labelled rows of df."""
    rows = df.select(df[label].cast("string").alias("lang"), df[text].cast("string").alias("text"))
    long = F.when(F.octet_length("text") > LONGEST, F.lit(1 << 61)).otherwise(F.lit(0))
    some = rows.where("lang is not null and length(text) > 0").withColumn("o", F.pmod(F.xxhash64("text"), F.lit(1 << 61)) + long)
    most = sample_rows + held_rows
    # the last hash that is wanted of each language: over distinct hashes, so copies don't count, and of rows of two columns
    least = some.select("lang", "o").distinct().withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("o"))).where(F.col("k") <= most)
    last = {r["lang"]: r["o"] for r in least.groupBy("lang").agg(F.max("o").alias("o")).collect()}
    if not last:
        return Model({})
    near = some.where(F.col("o") <= F.create_map(*[F.lit(x) for pair in last.items() for x in pair])[F.col("lang")])
    ranked = near.distinct().withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("o", "text"))).where(F.col("k") <= most)
    drawn: dict[str, list[str]] = {}
    for r in ranked.orderBy("lang", "k").select("lang", "text").collect():
        drawn.setdefault(r["lang"], []).append(r["text"])
    return _model(drawn, sample_rows)


def _accepted(model: Model, rate: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each row has letters and a rate within the limit of its best language."""
    if not model.limits or not len(rate):
        return length > 0
    best = np.argmin(rate, axis=1)
    limit = np.array([model.limits[x] for x in model.langs])[best] + SHORT / np.sqrt(np.maximum(length, 1))
    return (length > 0) & (rate[np.arange(len(rate)), best] <= limit)


def identify(df: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, rate, margin, accepted); rate and margin rounded to 6 places."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rate, length = rates(model, batch.column(1))
        some = (length > 0) & bool(model.langs)
        if model.langs:
            order = np.argsort(rate, axis=1, kind="stable")
            best = np.take_along_axis(rate, order[:, :1], 1)[:, 0]
            second = np.take_along_axis(rate, order[:, 1:2], 1)[:, 0] if rate.shape[1] > 1 else best
            lang = np.array(model.langs, dtype=object)[order[:, 0]]
        else:
            best = second = np.zeros(len(length))
            lang = np.full(len(length), None, dtype=object)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.where(some, lang, None), pa.string()), pa.array(np.round(best, 6), mask=~some), pa.array(np.round(second - best, 6), mask=~some), pa.array(_accepted(model, rate, length))], names=["doc_id", "lang", "rate", "margin", "accepted"])

    return map_batches(keyed(df), "doc_id long, lang string, rate double, margin double, accepted boolean", one)


def accepted(df: DataFrame, model: Model) -> DataFrame:
    """The rows of df, all columns, that ``identify`` accepts: one map over whole rows, no join."""
    index = df.columns.index("text")

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rate, length = rates(model, batch.column(index).cast(pa.string()))
        return batch.filter(pa.array(_accepted(model, rate, length)))

    return map_batches(df, df.schema, one)
