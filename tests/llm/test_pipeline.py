"""Every stage against a plain version, on what its predecessor kept."""

import re

import pytest
from test_decontaminate import plain_leaks
from test_lines import plain_removed
from test_simhash import plain_components, plain_print

import corpus_pipeline
from quayside.llm import pieces
from quayside.llm.queries import TOKENIZERS

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_one_after_the_other(spark, scratch):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "encoding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "s", None), (9002, "", "en", "s", 0), (9003, "12 34 %%", "en", "s", 8)], docs.schema)
    docs = scratch.keep(docs.unionByName(extra), "in")
    before = rows(docs)

    kept = scratch.keep(corpus_pipeline.language_id(spark, docs, SF), "languages")
    now = rows(kept)
    assert kept.columns == COLUMNS and set(now) == {i for i, r in before.items() if re.search(r"[^\W\d_]", r["text"] or "")}
    assert all(now[i] == before[i] for i in now)

    gone = plain_removed([(i, r["text"]) for i, r in now.items()])
    cut = {i: "\n".join(x for k, x in enumerate(r["text"].split("\n")) if (i, k) not in gone) for i, r in now.items()}
    touched = {i for i, _ in gone}
    kept = scratch.keep(corpus_pipeline.line_dedup(spark, kept, SF), "lines")
    now = rows(kept)
    assert kept.columns == COLUMNS and touched
    assert {i: (r["text"], r["n_chars"]) for i, r in now.items()} == {i: (t, len(t)) for i, t in cut.items() if i not in touched or t.split()}

    prints = {i: plain_print(r["text"]) for i, r in now.items()}
    root = plain_components(prints.items())
    before = now
    kept = scratch.keep(corpus_pipeline.near_dedup(spark, kept, SF), "near")
    now = rows(kept)
    assert kept.columns == COLUMNS and now == {i: r for i, r in before.items() if root[i] == i}

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {i for i, _ in plain_leaks([(i, r["text"]) for i, r in now.items()], items)}
    before = now
    kept = scratch.keep(corpus_pipeline.decontamination(spark, kept, SF), "clean")
    now = rows(kept)
    assert kept.columns == COLUMNS and now == {i: r for i, r in before.items() if i not in leaked}

    coded = scratch.keep(corpus_pipeline.encoding(spark, kept, SF), "coded")
    texts = {r["doc_id"]: r["text"] for r in pieces.decoded(coded, f"{TOKENIZERS}/piece_bpe_32k.model").collect()}
    assert texts == {i: r["text"] for i, r in now.items()}


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_and_empty_documents(spark, scratch, odd_documents, stage):
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, odd_documents, SF)
    assert out.count() <= odd_documents.count()
    if stage < 4:
        assert out.columns == odd_documents.columns
    assert run(spark, odd_documents.where("false"), SF).count() == 0
