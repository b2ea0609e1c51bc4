import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every maximal repetition, period by period."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i - start + p
            if length >= max(6, 4 * p):
                found.setdefault((start, length), p)
    return sorted((s, length, p) for (s, length), p in found.items())


def plain_row(doc_id, text, repeat=True):
    words = WORD.findall(text or "")
    n = len(words)
    if repeat and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, p in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def key(row):
    return tuple((v is None, v) for v in row)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
def test_all_runs_of_small_alphabets(lists):
    starts = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    t, s, n, p = runs.find(np.array([w for x in lists for w in x], np.int64), starts)
    got = sorted(zip(t.tolist(), s.tolist(), n.tolist(), p.tolist(), strict=True))
    assert got == sorted((i, *r) for i, x in enumerate(lists) for r in plain_runs(x))


def test_extensions_agree_with_word_by_word_comparison():
    rng = random.Random(1)
    piece = [rng.randrange(5) for _ in range(17)]
    lists = [piece * 9, [0] * 300, [rng.randrange(2) for _ in range(200)], [1], [0] * 300]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    made = runs.Extensions(np.array([w for x in lists for w in x]), starts)
    assert len(made.sample) < 0.4 * starts[-1]  # only the cover is sorted
    for k, words in enumerate(lists):
        n = len(words)
        pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
        pairs = rng.sample(pairs, min(len(pairs), 2000))
        if not pairs:
            continue
        i, j = np.array(pairs).T
        expected = [next((m for m in range(n - b) if words[a + m] != words[b + m]), n - b) for a, b in pairs]
        assert made.ahead(i + starts[k], j + starts[k]).tolist() == expected


def test_a_stretch_counts_under_its_smallest_period_only():
    words = ["a", "b"] * 20
    t, s, n, p = runs.find(np.array([0, 1] * 20), np.array([0, 40]))
    assert (s.tolist(), n.tolist(), p.tolist()) == ([0], [40], [2])
    assert plain_runs(words) == [(0, 40, 2)]


@pytest.mark.parametrize("repeat", [False, True])
def test_documents_against_the_plain_version(spark, odd_documents, repeat):
    rng = random.Random(2)
    odd = odd_documents.select("doc_id", "text").where("doc_id IS NULL OR doc_id <> 2")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for i in range(100, 250):
        head = [rng.choice("abcde") for _ in range(rng.randrange(40))]
        piece = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 30))]
        rows.append((i, " ".join(head + piece * rng.randrange(6) + head)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in runs.scan(docs, repeat=repeat).collect()]
    assert sorted(got, key=key) == sorted((plain_row(*r, repeat=repeat) for r in rows), key=key)


def test_very_long_and_odd_rows(spark, odd_documents):
    got = runs.scan(odd_documents, with_text=True).where("doc_id = 2").first()
    assert (got.n_runs, got.start, got.length, got.period, got.exponent_milli) == (1, 0, 40_000, 2, 20_000_000)
    assert (got.collapsed, got.runs) == ("word salad", "0,40000,2\n")
    assert runs.scan(odd_documents.limit(0), repeat=True).collect() == []


def test_given_documents_against_the_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(tuple(r) for r in runs.scan(docs, repeat=True).collect())
    assert got == sorted(plain_row(r.doc_id, r.text) for r in docs.collect())
