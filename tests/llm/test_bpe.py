import base64

import numpy as np
import pyarrow as pa
import pytest
from common import ODD, odd
from hypothesis import given, settings
from hypothesis import strategies as st

from voxweave.llm import bpe

tiktoken = pytest.importorskip("tiktoken")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def other():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.TOKENIZER, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


PIECES = ["'s", "'ll", "'", " ", "  ", "\n", "\t", "a", "the", "Ünder", "12", "٣", "日本", "😀", "!", "...", "xq", " ", " ", "re", "d", "\x1c"]


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=5))
def test_ids_are_those_of_another_encoder(other, texts):
    ids, splits, same = bpe.codec(bpe.TOKENIZER).encode_column(pa.array(texts, pa.string()))
    assert [ids[a:z].tolist() for a, z in zip(splits, splits[1:])] == [other.encode_ordinary(t) for t in texts]
    assert same.all()


def test_long_pre_tokens(other):
    for t in ("a" * 5000, "=" * 3000, "ab" * 2000 + " x", " " * 4000):
        assert bpe.codec(bpe.TOKENIZER).encode_column(pa.array([t]))[0].tolist() == other.encode_ordinary(t)


def test_perfect_hash():
    for n in (0, 1, 2, 3, 1000):
        keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
        p = bpe.PerfectHash(keys)
        assert sorted(p.slots(keys).tolist()) == list(range(n)) and (p.order[p.slots(keys)] == np.arange(n)).all()


def test_a_spoilt_hash_is_put_right(other):
    c = bpe.Codec(bpe.read_ranks()[:2000])
    c.slot_id = c.slot_id[::-1].copy()
    texts = ["hello there", "and more"]
    ids, splits, same = c.encode_column(pa.array(texts))
    assert same.all() and b"".join(c.entries[i] for i in ids[: splits[1]]) == b"hello there"


def test_frames(spark):
    got = bpe.encode(odd(spark)).collect()
    assert len(got) == len(ODD) and all(r["round_trip"] for r in got)
    assert sum(r["ids"] is None for r in got) == 2
    back = {(r["doc_id"], r["text"]) for r in bpe.decode(bpe.encode(odd(spark))).collect()}
    assert back == {(i, t) for i, t, _ in ODD}
    assert bpe.encode(odd(spark).limit(0)).count() == 0


def test_ids_are_decoded_in_runs(spark, monkeypatch):
    """Of few ids, a longer row by itself; empty and null rows anywhere."""
    texts = ["", "ab " * 40, None, "x", "ñandú y más " * 30, "", None, "z" * 5, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for limit in (1, 7, 1 << 17):
        monkeypatch.setattr(bpe, "DECODE_IDS", limit)
        assert {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(df)).collect()} == dict(enumerate(texts))
