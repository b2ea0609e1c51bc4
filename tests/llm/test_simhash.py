import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from quayside.llm import simhash
from quayside.llm.batches import xxh64_slices
from quayside.llm.components import connected


def plain_print(text, width=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + width]).encode(), 42) for i in range(max(1, len(w) - width + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, most_bits=2):
    rows = list(rows)
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in rows:
        for j, b in rows:
            if (a ^ b).bit_count() <= most_bits:
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: top(i) for i in root}


def test_slices_hash_as_xxh64():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 5000, dtype=np.uint8).tobytes()
    sizes = np.concatenate((np.arange(0, 300), [1000, 4000]))
    begins = np.array([int(rng.integers(0, 5000 - s)) for s in sizes])
    for seed in (0, 42):
        assert xxh64_slices(data, begins, sizes, seed).tolist() == [xxhash.xxh64_intdigest(data[b : b + s], seed) for b, s in zip(begins, sizes, strict=True)]


def test_prints_of_odd_texts():
    texts = ["", " \n", "a", "A b", "a b c", "x " * 999, "Ä\x0bÖ ü É", "\x1f\x1c y z\x85w", "q" * 400 + " r s t"]
    assert simhash.batch_fingerprints(pa.array(texts, pa.large_string())).tolist() == [plain_print(t) for t in texts]


def test_components_against_all_pairs(spark, scratch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs, scratch).collect()}
    prints = {r["doc_id"]: plain_print(r["text"]) for r in docs.collect()}
    root = plain_components(prints.items())
    assert got == {i: (f"{prints[i]:016x}", root[i]) for i in prints}


def test_links_of_dense_prints(spark, scratch):
    """A large group in which prints differ in few bits of few bytes, and chains that leave it."""
    rng = np.random.default_rng(1)
    base = 0x0123456789ABCDEF
    prints = {base} | {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 16, (400, 2))}
    prints |= {base ^ sum(1 << int(b) for b in bits) for bits in rng.integers(0, 64, (300, 4))} | {int(x) for x in rng.integers(0, 2**63, 100)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"))
    rows = connected(edges, scratch).collect()
    got = {r["node"] & (2**64 - 1): r["root"] & (2**64 - 1) for r in rows}
    expected = plain_components([(p, p) for p in prints])
    groups = {}
    for p in prints:
        groups.setdefault(expected[p], set()).add(p)
    found = {}
    for p in prints:
        found.setdefault(got.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))
    assert edges.count() < 28 * len(prints)


def test_components_of_paths_hubs_and_loops(spark, scratch):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3), (None, 4), (900, 901), (901, 900)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(200, 260)} | {7: 7, 900: 900, 901: 900}


def test_odd_rows(spark, scratch, odd_documents):
    rows = simhash.near_duplicates(odd_documents, scratch).collect()
    assert len(rows) == odd_documents.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["component_id"] == by[1]["component_id"] == by[5]["component_id"] == 0 and by[1]["fingerprint"] == "0" * 16
    assert by[None]["component_id"] is None
    kept = simhash.keep_one(odd_documents, scratch)
    assert kept.columns == odd_documents.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 2, 3, 6, 7]


def test_empty_table(spark, scratch, odd_documents):
    none = odd_documents.where(F.lit(False))
    assert simhash.near_duplicates(none, scratch).count() == 0 and simhash.keep_one(none, scratch).count() == 0


def test_one_of_each_group_stays_by_id_and_text(spark, scratch):
    rows = [(1, "a b c d e f g"), (1, "unlike text under the same id"), (None, "A b c d e f g"), (None, "its own text"), (None, "its own text"), (5, "its  own text"), (1, "a b c d e f g")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), scratch).collect()
    assert sorted(map(tuple, kept)) == [(1, "a b c d e f g"), (1, "unlike text under the same id"), (5, "its  own text")]
