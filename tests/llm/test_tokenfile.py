import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm import tokenfile
from quayside.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"


@pytest.mark.parametrize("values", [[], [7], [0] * 700, list(range(256)), [2**32 - 1, 0] * 300, [5] * 255 + [2**31]])
def test_blocks(values):
    values = np.array(values, dtype=np.uint32)
    blocks = tokenfile.pack(values)
    assert len(blocks) == -(-len(values) // tokenfile.BLOCK)
    assert (tokenfile.unpack(blocks) == values).all() if blocks else True


def test_outliers_are_exceptions():
    rng = np.random.default_rng(0)
    values = rng.integers(1000, 1016, 256).astype(np.uint32)
    values[17], values[200] = 50_000, 4_000_000
    (block,) = tokenfile.pack(values)
    low, width, n, exceptions = tokenfile._HEAD.unpack_from(block)
    assert (low, width, n, exceptions) == (1000, 4, 256, 2) and len(block) < 160


def test_ranges_by_the_index():
    ids = np.random.default_rng(1).integers(0, 50_257, 1_300_000).astype(np.uint32)
    out = io.BytesIO()
    writer = tokenfile.Writer(out)
    for a in range(0, len(ids), 70_001):
        part = ids[a : a + 70_001]
        writer.add(np.array([a]), np.array([True]), np.array([len(part)]), part)
    writer.close()
    out.size = lambda: len(out.getvalue())
    reader = tokenfile.Reader(out)
    for a, b in ((0, 1), (255, 257), (1_299_999, 1_300_000), (500_000, 1_200_001), (5, 5), (0, 10**9)):
        assert (reader.ids(a, b) == ids[a:b]).all()
    assert (np.concatenate([p for _, _, p in reader.documents()]) == ids).all()


def test_ids_are_the_tokenizers():
    texts = [
        "", "a", "  ", " a  b\n\n c  ", "don't it's", "x\n", "\n x", "  \n  y", "\t\tz", "É é×÷ ü  12ab34 ,,,!!", "<|endoftext|> hi", "hello <|endoftext|> world", "a<|endoftext|><|endoftext|>b", "<|endoftext| >", "  x", "a\x85b", "a\xa0b", "你好 ", "a\x1cb \x1d c", "1²",
        "a\x0bb\x0c c\r\nd", "...  ...\n...", "ʰ ɐ ə", "w" * 5000, " ".join(f"wörd{i}" for i in range(3000)),
    ]
    starts, ids = tokenfile.encode(pa.array(texts, pa.large_string()), PATH, 2)
    plain = Tokenizer.from_file(PATH)
    for k, text in enumerate(texts):
        assert ids[starts[k] : starts[k + 1]].tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2], text


def test_files_against_the_library(spark, scratch, odd_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_documents.select(F.col("doc_id") - 100, "text").toDF("doc_id", "text"))
    files = tokenfile.write(docs.repartition(6), scratch.path("ids"), scratch, PATH)
    got = [tuple(r) for r in tokenfile.read(files).orderBy("start").collect()]
    plain, start, expected = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert got == expected and files.count() > 1


def test_empty_table(spark, scratch, odd_documents):
    files = tokenfile.write(odd_documents.where(F.lit(False)), scratch.path("ids"), scratch, PATH)
    assert files.count() == 0 and tokenfile.read(files).count() == 0
