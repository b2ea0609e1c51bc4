"""The registered queries of this subpackage, over whole tables with the parameters meant for production."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, langid, licenses, lines, lm, manifest, pieces, quality, runs, simhash, sketch, tokenfile, warc
from quayside.plans.session import Scratch
from quayside.plans.tables import Registry, table

registry = Registry()

# The folder of the public tokenizer files; they lie at the same place on every machine.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


@registry.add()
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of an archive, as read back from the archives."""
    scratch = Scratch(spark)
    archives = warc.write(table(spark, sf_dir, "pages"), scratch.path("warc"), scratch)
    return warc.read(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


@registry.add()
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, and whether it decodes to the text."""
    return pieces.encode_sampled(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


@registry.add()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main language of every document, learnt from those outside the held-out fold."""
    documents = table(spark, sf_dir, "documents")
    model = langid.learn(documents.where(~langid.held_out("doc_id")), Scratch(spark))
    found = langid.predict(documents, model, ["doc_id"])
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score", F.to_json("shares").alias("shares"))


@registry.add()
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and log probabilities of every document, learnt from those outside the held-out fold."""
    return lm.scores(table(spark, sf_dir, "documents"), Scratch(spark))


@registry.add()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark))


@registry.add()
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier line exactly or nearly."""
    found = lines.without_repeats(table(spark, sf_dir, "documents"), Scratch(spark))
    return found.select("doc_id", "n_lines", "n_removed", "text")


@registry.add()
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's token ids, as read back from the token files."""
    scratch = Scratch(spark)
    files = tokenfile.write(table(spark, sf_dir, "documents"), scratch.path("ids"), scratch, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.read(files)


@registry.add()
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against that of its edited text and of the next document."""
    return sketch.edit_likeness(table(spark, sf_dir, "documents"))


@registry.add()
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"), Scratch(spark))


@registry.add()
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best window of every document and benchmark item that match."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark))


@registry.add()
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances to the nearest language and verdict of every document."""
    documents = table(spark, sf_dir, "documents")
    return quality.judge(documents, quality.learn(documents, Scratch(spark)))


@registry.add(sql=manifest.oracle_sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that its tampered form folds to."""
    return manifest.proofs(table(spark, sf_dir, "documents"), Scratch(spark))


@registry.add()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of them made to end in a repeated piece."""
    return runs.scan(table(spark, sf_dir, "documents"), repeat=True)
