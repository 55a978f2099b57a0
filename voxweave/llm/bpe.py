"""Byte-level BPE: a minimal perfect hash for pre-tokens that are vocabulary entries, a heap over linked bytes for the rest.

``encode(df)`` gives (doc_id, n_tokens, ids, round_trip); ``decode(df)`` gives (doc_id, text).

Tier 1. Pre-tokens are cut from a slice of many rows at once, from the class of
each code point (letter, number, space, other), by the rules of the pattern
``'(s|t|re|ve|m|ll|d)| ?L+| ?N+| ?[^\\sLN]+|\\s+(?!\\S)|\\s+``. Each one's 64-bit
hash is looked up in a minimal perfect hash of the vocabulary (one slot a key,
no empty slot), whose slot holds the key's hash, length and id. Byte-level BPE
of a whole pre-token that is an entry is that entry, as long as the vocabulary's
merges reach it; entries that they don't reach are left out of the hash.

Tier 2. Distinct misses are merged lowest rank first, with a heap of pairs over
a doubly linked list of byte parts: O(n log n), whatever the length. A bounded
per-process memo of two generations keeps those seen of late; it changes no result.

Every row is decoded again and compared with its text (``round_trip``); a row
that a hash collision had spoilt would be encoded anew by tier 2 alone.

Defined cases. A null text has null ids, 0 tokens and round_trip true; an empty
one has no ids. Very long texts are encoded whole. Repeated rows and null doc_id are encoded row by row, like any. Ties: of merges of equal rank the leftmost is made first.
An empty table gives no rows. Only doc_id and text (or ids) are read, so other columns can't clash. The vocabulary file at ``path`` must be on all executors, like the code.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from .util import keyed, map_batches

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MEMO = 150_000
SLICE = 1 << 20

_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_OTHER, _LETTER, _NUMBER, _BLANK = 0, 1, 2, 3
_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """Class of each code point."""
    global _classes
    if _classes is None:
        kinds = {"L": _LETTER, "N": _NUMBER}
        out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        out[_SPACE] = _BLANK
        _classes = out
    return _classes


def read_ranks(path: str = TOKENIZER) -> list[bytes]:
    """Entries of a rank file, by id."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * (max(int(n) for _, n in pairs) + 1)
    for token, n in pairs:
        out[int(n)] = base64.b64decode(token)
    return out


_FAR = 1 << 40


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE of one pre-token: a heap of rank and position, packed in one number, over linked parts."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    get = ranks.get
    pair = [get(piece[i : i + 2], _FAR) for i in range(n - 1)]  # rank of the part that starts here with the next one
    heap = [(r << 32) + i for i, r in enumerate(pair) if r != _FAR]
    pair.append(_FAR)
    nxt = list(range(1, n + 2))
    prev = list(range(-1, n))
    heapify(heap)
    while heap:
        top = heappop(heap)
        i = top & 0xFFFFFFFF
        if pair[i] != top >> 32:
            continue  # one of the two parts was merged meanwhile
        j = nxt[i]
        k = nxt[i] = nxt[j]
        pair[j] = -1
        prev[k] = i
        if k < n:
            pair[i] = r = get(piece[i : nxt[k]], _FAR)
            if r != _FAR:
                heappush(heap, (r << 32) + i)
        else:
            pair[i] = _FAR
        p = prev[i]
        if p >= 0:
            pair[p] = r = get(piece[p:k], _FAR)
            if r != _FAR:
                heappush(heap, (r << 32) + p)
    out, i = [], 0
    while i < n:
        k = nxt[i]
        out.append(ranks[piece[i:k]])
        i = k
    return out


class PerfectHash:
    """Hash-and-displace over distinct 64-bit hashes: as many slots as keys. A bucket of one key names its slot outright."""

    def __init__(self, hashes: np.ndarray):
        self.n = n = len(hashes)
        self.buckets = max(1, n // 3)
        self.shift = np.zeros(self.buckets, np.int64)
        taken = np.zeros(n, dtype=bool)
        self.order = np.zeros(n, np.int64)  # slot -> key
        if not n:
            return
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        first = np.concatenate([[0], np.cumsum(counts)])
        tries = np.arange(256, dtype=np.int64)
        for b in np.argsort(-counts, kind="stable"):
            keys = by[first[b] : first[b + 1]]
            if len(keys) < 2:
                break
            base = 0
            while True:
                slots = self._slot(hashes[keys][None, :], (base + tries)[:, None])
                fits = ~taken[slots].any(axis=1)
                fits[fits] = (np.diff(np.sort(slots[fits], axis=1), axis=1) > 0).all(axis=1)
                if fits.any():
                    break
                base += len(tries)
                if base > 64 * n + 4096:
                    raise ValueError("two keys have the same hash")
            at = int(np.argmax(fits))
            self.shift[b], taken[slots[at]] = base + at, True
            self.order[slots[at]] = keys
        free = iter(np.flatnonzero(~taken).tolist())
        for b in np.flatnonzero(counts == 1).tolist():
            slot = next(free)
            self.shift[b], self.order[slot] = -slot - 1, by[first[b]]

    def _slot(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        x = (h ^ (d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return (((x * np.uint64(0x94D049BB133111EB)) >> np.uint64(32)) * np.uint64(self.n) >> np.uint64(32)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        d = self.shift[hashes % np.uint64(self.buckets)]
        return np.where(d < 0, -d - 1, self._slot(hashes, d))


class Codec:
    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.ranks = {e: i for i, e in enumerate(entries) if e}
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        every = K.span_hashes(self.flat, self.starts, self.starts + self.lengths)
        keys = [i for i, e in enumerate(entries) if e and merge(e, self.ranks) == [i]]
        _, first = np.unique(every[keys], return_index=True)
        keys = np.array(keys, np.int64)[np.sort(first)]
        self.perfect = PerfectHash(every[keys])
        keys = keys[self.perfect.order]
        self.slot_hash, self.slot_id, self.slot_length = every[keys], keys.astype(np.int32), self.lengths[keys]
        self.memo: dict[int, bytes] = {}
        self.old: dict[int, bytes] = {}

    def _chars(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points, and the byte at which each starts, and the end. A byte that isn't UTF-8 counts as a character."""
        cp = np.frombuffer(raw.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
        width = np.ones(len(cp), np.int64)
        width += (cp >= 0x80) & ((cp < 0xDC80) | (cp > 0xDCFF))
        width += (cp >= 0x800) & ((cp < 0xDC80) | (cp > 0xDCFF))
        width += cp >= 0x10000
        return cp, np.concatenate([[0], np.cumsum(width)])

    def pretokens(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte starts of the pre-tokens of all rows."""
        if not len(raw):
            return np.zeros(0, np.int64)
        cp, at = self._chars(raw)
        kind = classes()[cp]
        n = len(cp)
        rows = np.searchsorted(at, offsets[:-1][np.diff(offsets) > 0])
        head = np.zeros(n + 1, dtype=bool)
        head[rows] = head[n] = True
        start = head.copy()
        start[1:n] |= kind[1:] != kind[:-1]
        blank = kind == _BLANK
        after = np.flatnonzero(blank[:-1] & ~blank[1:] & ~head[1:n])  # the last blank before something else
        start[after] = True
        start[after[cp[after] == 32] + 1] = False
        quote = np.flatnonzero((cp == 39) & start[:n])
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == _LETTER) & ~head[quote + 1]]
        if len(quote):
            a = cp[quote + 1]
            third = np.where(quote + 2 < n, quote + 2, quote)
            b = np.where((quote + 2 < n) & ~head[third], cp[third], 0)
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            one = np.isin(a, [ord(c) for c in "stmd"])
            start[quote[one | two] + 1] = False
            start[quote[one] + 2] = True
            start[quote[two] + 3] = True
        return at[np.flatnonzero(start[:n])]

    def encode_rows(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, splits by row)."""
        starts = self.pretokens(raw, offsets)
        ends = np.concatenate([starts[1:], [len(raw)]]).astype(np.int64) if len(starts) else starts
        hashes = K.span_hashes(raw, starts, ends)
        slot = self.perfect.slots(hashes)
        hit = (self.slot_hash[slot] == hashes) & (self.slot_length[slot] == ends - starts)
        many = np.ones(len(starts), np.int64)
        miss = np.flatnonzero(~hit)
        if len(miss):
            distinct, first, back = np.unique(hashes[miss], return_index=True, return_inverse=True)
            pool, counts, data = [], np.zeros(len(distinct), np.int64), raw.tobytes()
            if len(self.memo) > MEMO:
                self.old, self.memo = self.memo, {}
            memo, old = self.memo, self.old
            a, z = starts[miss[first]].tolist(), ends[miss[first]].tolist()
            for i, h in enumerate(distinct.tolist()):
                ids = memo.get(h)
                if ids is None:
                    ids = old.get(h)
                    if ids is None:
                        ids = array("i", merge(data[a[i] : z[i]], self.ranks)).tobytes()
                    if z[i] - a[i] <= 64:
                        memo[h] = ids
                pool.append(ids)
                counts[i] = len(ids) >> 2
            many[miss] = counts[back]
        splits = np.concatenate([[0], np.cumsum(many)])
        out = np.empty(splits[-1], np.int32)
        out[splits[:-1][hit]] = self.slot_id[slot[hit]]
        if len(miss):
            begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
            k = many[miss]
            inner = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            out[np.repeat(splits[:-1][miss], k) + inner] = np.frombuffer(b"".join(pool), np.int32)[np.repeat(begin[back], k) + inner]
        return out, splits[np.searchsorted(starts, offsets)]

    def decode_rows(self, ids: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, byte offsets by row)."""
        length = self.lengths[ids]
        ends = np.concatenate([[0], np.cumsum(length)])
        source = np.repeat(self.starts[ids] - ends[:-1], length) + np.arange(ends[-1])
        return self.flat[source], ends[splits]

    def encode_slow(self, text: bytes) -> list[int]:
        raw = np.frombuffer(text, np.uint8)
        cuts = [*self.pretokens(raw, np.array([0, len(raw)])).tolist(), len(text)]
        return [i for a, z in zip(cuts, cuts[1:]) for i in merge(text[a:z], self.ranks)]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, splits, whether each row decodes to itself)."""
        raw, offsets = K.buffers(column)
        ids, counts, same = [], [], np.ones(len(column), dtype=bool)
        for i, j, part, off in K.slices(raw, offsets, SLICE):
            got, splits = self.encode_rows(part, off)
            back, ends = self.decode_rows(got, splits)
            if len(back) != len(part) or not np.array_equal(back, part):
                lists = [self.encode_slow(part[off[r] : off[r + 1]].tobytes()) for r in range(j - i)]
                got = np.array([x for one in lists for x in one], np.int32)
                splits = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
                back, ends = self.decode_rows(got, splits)
                same[i:j] = [back[ends[r] : ends[r + 1]].tobytes() == part[off[r] : off[r + 1]].tobytes() for r in range(j - i)]
            ids.append(got)
            counts.append(np.diff(splits))
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), np.concatenate([[0], np.cumsum(np.concatenate(counts) if counts else np.zeros(0, np.int64))]).astype(np.int64), same


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec a process and vocabulary."""
    if path not in _codecs:
        _codecs[path] = Codec(read_ranks(path))
    return _codecs[path]


def encode(df: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every row; ``path`` must be readable on all executors."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column(1)
        ids, splits, same = codec(path).encode_column(text)
        null = np.asarray(text.is_null())
        lists = pa.ListArray.from_arrays(pa.array(splits.astype(np.int32)), pa.array(ids), mask=pa.array(null) if null.any() else None)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(splits).astype(np.int32)), lists, pa.array(same)], names=["doc_id", "n_tokens", "ids", "round_trip"])

    return map_batches(keyed(df), "doc_id long, n_tokens int, ids array<int>, round_trip boolean", one)


#: Ids that are decoded at once, if a row alone hasn't more.
DECODE_IDS = 1 << 17


def decode(df: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, text) from (doc_id, ids). Null ids have a null text; ids outside the vocabulary are an error."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        c, column = codec(path), batch.column(1)
        null = column.is_null().to_pylist()
        splits = np.concatenate([[0], np.cumsum([0 if x is None else x for x in column.value_lengths().to_pylist()])]).astype(np.int64)
        ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(c.entries)):
            raise ValueError("an id is outside the vocabulary")
        texts, a = [], 0
        while a < len(null):  # a run of rows at a time: a byte takes some 30 more on its way
            z = max(a + 1, int(np.searchsorted(splits, splits[a] + DECODE_IDS, "right")) - 1)
            raw, ends = c.decode_rows(ids[splits[a] : splits[z]], splits[a : z + 1] - splits[a])
            data = raw.tobytes()
            texts += [None if gone else data[ends[i] : ends[i + 1]].decode("utf-8", "replace") for i, gone in enumerate(null[a:z])]
            a = z
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(df.select(df["doc_id"].cast("long").alias("doc_id"), df["ids"].cast("array<int>").alias("ids")), "doc_id long, text string", one)
