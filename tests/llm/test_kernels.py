import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from voxweave.llm import kernels as K

TEXT = st.text(alphabet=st.sampled_from("aZÀÞ×ß_- .\n'9ªµº «»—日x’😀"), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.sampled_from([1, 7, 1 << 20]))
def test_words_are_those_of_plain_python(texts, size):
    raw, offsets = K.buffers(pa.array(texts, pa.string()))
    got = []
    for _, _, part, off in K.slices(raw, offsets, size):
        w = K.words(part, off)
        data = part.tobytes()
        for a, z in zip(w.splits[:-1], w.splits[1:]):
            got.append([K.fold(data[s:e].decode()) for s, e in zip(w.starts[a:z], w.ends[a:z])])
    assert got == [K.words_of(t) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(TEXT, max_size=6), st.integers(1, 4))
def test_ngrams_agree_with_sets(texts, n):
    raw, offsets = K.buffers(pa.array(texts, pa.string()))
    sets, splits = K.distinct(*K.ngrams(K.words(raw, offsets), n))
    for k, t in enumerate(texts):
        w = K.words_of(t)
        plain = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
        assert splits[k + 1] - splits[k] == len(plain)


def test_sliced_and_large_arrays():
    a = pa.array(["x y", None, "zz", ""], pa.large_string())[1:]
    raw, offsets = K.buffers(pa.chunked_array([a, a]))
    assert raw.tobytes() == b"zzzz" and offsets.tolist() == [0, 0, 2, 2, 2, 4, 4]
    assert K.buffers(pa.array([], pa.string()))[1].tolist() == [0]


def test_sieve(spark):
    from voxweave.llm.util import sieve, sifted

    ids = spark.range(0, 3000, 3)
    told = {r["id"]: r["__may"] for r in sifted(spark.range(-50, 4000), "id", sieve(ids)).collect()}
    assert all(told[k] for k in range(0, 3000, 3)) and sum(told.values()) < 1100
    assert not any(r["__may"] for r in sifted(spark.range(10), "id", sieve(ids.limit(0))).collect())
    odd = spark.createDataFrame([(None,), (3,)], "id long")
    assert {r["id"] for r in sifted(odd, "id", sieve(ids)).where("__may").collect()} >= {3}
