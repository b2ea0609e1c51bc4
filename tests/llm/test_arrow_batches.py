import numpy as np
import pyarrow as pa
import xxhash

from quayside.llm.batches import Words, hash64, shingle_hashes, slices


def test_words_and_hashes():
    texts = ["a b", "", "  x\x0by\tz\n", "\x1c é", "a" * 300 + " b"]
    words = Words(pa.array(texts, pa.large_string()))
    got = [words.vocabulary.take(pa.array(words.codes[a:b])).to_pylist() for a, b in zip(words.starts, words.starts[1:], strict=False)]
    assert got == [["a", "b"], [], ["x", "y", "z"], ["\x1c", "é"], ["a" * 300, "b"]]
    assert hash64(words.vocabulary, 5).tolist() == [xxhash.xxh64_intdigest(w.encode(), 5) for w in words.vocabulary.to_pylist()]


def test_shingles_by_hand():
    counts = [0, 1, 2, 3, 4, 7, 3]
    rng = np.random.default_rng(0)
    words = rng.integers(1, 6, sum(counts)).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(counts)))
    hashes, runs = shingle_hashes(words * np.uint64(0x12345678DEADBEEF), starts, 3)
    seen = {}
    for k, n in enumerate(counts):
        expected = [tuple(words[starts[k] + i : starts[k] + i + min(3, n)].tolist()) for i in range(max(n - 2, min(n, 1)))]
        got = hashes[runs[k] : runs[k + 1]].tolist()
        assert len(got) == len(expected)
        for g, e in zip(got, expected, strict=True):
            assert seen.setdefault(e, g) == g
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_the_batch():
    batch = pa.RecordBatch.from_arrays([pa.array([None, "", "x" * 50, "y", None, "z" * 500, ""])], names=["t"])
    parts = list(slices(batch, "t", 40))
    assert [v for p in parts for v in p.column(0).to_pylist()] == batch.column(0).to_pylist() and len(parts) > 1
