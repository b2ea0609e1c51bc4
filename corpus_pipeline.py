"""A corpus clean-up: five stages, each written and read again as the next one's documents.

ORACLE_SQL is None: learning, sampling and fingerprints are not SQL. tests/llm holds every stage against a plain version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, langid, lines, pieces, simhash
from quayside.llm.queries import TOKENIZERS
from quayside.plans.session import Scratch, configure
from quayside.plans.tables import table

ORACLE_SQL = None
# A document stays when one language has at least this share of its words.
MIN_SHARE = 0.5
# Text in the last stage's work at a time: workers still hold what earlier stages needed, so it takes less than the operator alone.
ENCODED_BYTES = 250_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with text in which one of the learnt languages has at least ``MIN_SHARE``; null and letterless texts go."""
    model = langid.learn(docs, Scratch(spark))
    found = langid.predict(docs, model, docs.columns, names=("__lang", "__score", "__shares"))
    kept = found.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= MIN_SHARE))
    return kept.select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines seen before; ``n_chars`` follows the text, documents that lose all their words go."""
    cut = lines.without_repeats(docs, Scratch(spark), counts=("__lines", "__removed"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("__removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return cut.where((F.col("__removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: three-word shingles, fingerprints that differ in at most two bits."""
    return simhash.keep_one(docs, Scratch(spark))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"), Scratch(spark))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled piece ids of every document that is left."""
    return pieces.encode_sampled(docs, f"{TOKENIZERS}/piece_bpe_32k.model", size=ENCODED_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each returns is written in the shared folder and read again."""
    configure(spark)
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return scratch.keep(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
