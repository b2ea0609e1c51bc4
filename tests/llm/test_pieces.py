import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import pieces
from quayside.llm.batches import mix
from quayside.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/piece_bpe_32k.model"


def test_samples_follow_the_lattice():
    """Against all segmentations of a word, listed."""
    import sentencepiece

    m = pieces.model(PATH, 0.5)
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = {sp.id_to_piece(j): j for j in range(259, sp.get_piece_size())}
    word, expected, n = "▁then", {}, 50_000
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        at = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in itertools.pairwise(at)]
        if all(p in ids for p in parts):
            expected[tuple(ids[p] for p in parts)] = math.exp(sum(m.weight[ids[p]] for p in parts))
    total = sum(expected.values())
    starts, drawn = pieces.sample(pa.array(["then"] * n, pa.large_string()), mix(np.arange(n, dtype=np.uint64)), m)
    got = Counter(tuple(drawn[starts[q] : starts[q + 1]].tolist()) for q in range(n))
    assert set(got) <= set(expected)
    assert all(abs(got[k] / n - v / total) < 0.01 for k, v in expected.items())


@pytest.mark.parametrize("alpha", [0.0, 1.0])
def test_every_text_comes_back(alpha):
    m = pieces.model(PATH, alpha)
    texts = ["", " ", "  a  b\n\n c ", "Élan 你好 ▁x▁ \x01\x00 😀", "x" * 300, "a\tb\r\n", "ÿ" * 100 + "字𠮷" * 80, "the " * 500, "\n", "▁"]
    starts, ids = pieces.sample(pa.array(texts, pa.large_string()), mix(np.arange(len(texts), dtype=np.uint64)), m)
    assert pieces.decode(starts, ids, m).to_pylist() == texts
    assert starts[1] == 0 and (np.diff(starts)[1:] > 0).all()


def test_rows_do_not_depend_on_their_batch(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = {r["doc_id"]: r["ids"] for r in pieces.encode_sampled(docs, PATH).collect()}
    b = {r["doc_id"]: r["ids"] for r in pieces.encode_sampled(docs.repartition(7), PATH).collect()}
    other = {r["doc_id"]: r["ids"] for r in pieces.encode_sampled(docs, PATH, seed=1).collect()}
    assert a == b and sum(a[i] != other[i] for i in a) > 0.9 * len(a)


def test_decoding_and_odd_rows(spark, odd_documents):
    coded = pieces.encode_sampled(odd_documents, PATH)
    rows = coded.collect()
    assert len(rows) == odd_documents.count() and all(r["lossless"] and len(r["ids"]) == r["n_pieces"] for r in rows)
    texts = {r["doc_id"]: r["text"] for r in pieces.decoded(coded, PATH).collect()}
    assert texts == {r["doc_id"]: r["text"] or "" for r in odd_documents.collect()}
    assert pieces.encode_sampled(odd_documents.where(F.lit(False)), PATH).count() == 0
