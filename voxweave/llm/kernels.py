"""Vectorised text kernels shared by the corpus operators.

Everything here works on the raw UTF-8 buffer of an Arrow string column, a
slice of about ``SLICE_BYTES`` at a time, so no Python string is made per word
and the working set stays in cache whatever the batch holds.

Words: maximal runs of word bytes after folding. Folding lowers A-Z and the
Latin-1 capitals (U+00C0-U+00DE). Word bytes are ASCII letters and digits and
every byte of a non-ASCII character, except those of U+0080-U+00BF (but for
ª, µ, º) and U+2000-U+207F, which hold spaces and punctuation.
``fold``/``words_of`` state the same rule in plain Python for tests.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_B = np.uint64(0x9E3779B97F4A7C15)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True

_pow = np.ones(1, dtype=np.uint64)
_pow_inv = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _pow_inv
    if len(_pow) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("_pow", _B), ("_pow_inv", _B_INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            globals()[name] = np.multiply.accumulate(p)
    return _pow, _pow_inv


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    n = len(column)
    _, off, data = column.buffers()
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, dtype=kind, count=column.offset + n + 1)[column.offset :].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def slices(raw: np.ndarray, offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of about ``size`` bytes; a longer row is a run by itself."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


@dataclass
class Words:
    """Words of a run of rows: byte ``starts`` and ``ends``, a 64-bit ``hash`` each, and ``splits`` (rows + 1) into them by row."""

    starts: np.ndarray
    ends: np.ndarray
    hash: np.ndarray
    splits: np.ndarray


def fold_bytes(raw: np.ndarray) -> np.ndarray:
    folded = _FOLD[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) + 1 if len(raw) else np.zeros(0, np.int64)
    if len(lead):
        second = raw[lead]
        lead = lead[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]
        folded[lead] += 0x20
    return folded


def word_mask(raw: np.ndarray) -> np.ndarray:
    mask = _WORD[raw]
    n = len(raw)
    if n > 1:
        at = np.flatnonzero(raw[:-1] == 0xC2)
        if len(at):
            second = raw[at + 1]
            at = at[(second != 0xAA) & (second != 0xB5) & (second != 0xBA)]
            mask[at] = mask[at + 1] = False
    if n > 2:
        at = np.flatnonzero(raw[:-2] == 0xE2)
        if len(at):
            at = at[(raw[at + 1] == 0x80) | (raw[at + 1] == 0x81)]
            mask[at] = mask[at + 1] = mask[at + 2] = False
    return mask


def span_hashes(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, by one prefix sum of byte x base^position."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, inv = _powers(len(folded) + 1)
    total = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum((folded.astype(np.uint64) + np.uint64(1)) * p[: len(folded)], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    mask = word_mask(raw)
    edge = np.zeros(len(raw) + 1, dtype=np.int8)
    if len(raw):
        edge[1:-1] = mask[1:].view(np.int8) - mask[:-1].view(np.int8)
        edge[0], edge[-1] = mask[0], -int(mask[-1])
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    cut = np.unique(inner[mask[inner] & mask[inner - 1]]) if len(inner) else inner  # a word can't go on into the next row
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return Words(starts, ends, span_hashes(fold_bytes(raw), starts, ends), np.searchsorted(starts, offsets))


def ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, splits by row) of the word n-grams; a row of fewer than n words, but not none, is one n-gram of them all."""
    counts = np.diff(w.splits)
    many = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
    splits = np.concatenate([[0], np.cumsum(many)])
    first = np.repeat(w.splits[:-1] - splits[:-1], many) + np.arange(splits[-1])
    last = np.repeat(w.splits[1:], many)
    total = np.zeros(len(first), np.uint64)
    padded = np.concatenate([w.hash, np.zeros(n, np.uint64)])
    for k in range(n):
        term = padded[first + k]
        if (counts < n).any():
            term = np.where(first + k < last, term, np.uint64(0))
        total = mix(total * np.uint64(0xD1342543DE82EF95) + term + np.uint64(k + 1))
    return total, splits


def distinct(hashes: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, and the new splits."""
    row = np.repeat(np.arange(len(splits) - 1), np.diff(splits))
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    keep = np.ones(len(h), dtype=bool)
    if len(h) > 1:
        keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[keep], r[keep]
    return h, np.searchsorted(r, np.arange(len(splits)))


def reduce_rows(ufunc: np.ufunc, values: np.ndarray, splits: np.ndarray, empty) -> np.ndarray:
    """``ufunc`` over each row's values; ``empty`` where a row has none."""
    out = np.full(len(splits) - 1, empty, dtype=values.dtype)
    some = np.flatnonzero(np.diff(splits) > 0)
    if len(some):
        out[some] = ufunc.reduceat(values, splits[some])
    return out


def fold(text: str) -> str:
    """What the folding does, in plain Python."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text)


_PLAIN = re.compile("(?:[0-9a-zªµºÀ-῿₀-\U0010ffff])+")


def words_of(text: str | None) -> list[str]:
    """What ``words`` finds, in plain Python."""
    return _PLAIN.findall(fold(text or ""))
