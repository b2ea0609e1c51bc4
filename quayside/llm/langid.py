"""Languages of a document as a mixture: EM over n-gram likelihoods, the set chosen by penalised likelihood."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.batches import Words, column, doc_ids_type, map_arrow, mapped, raw, texts
from quayside.plans.session import Scratch, hinted

UNKNOWN = "und"
BUCKETS = 1 << 16
# Rows learnt from, per language: those with the smallest hash of their id.
ROWS_PER_LANGUAGE = 1000
SMOOTHING = 0.1
# Parts of the range of hashes, to rank few rows in a task.
STRIPES = 1 << 16
# What one more language must add to the log likelihood, times the logarithm of the words.
PENALTY = 4.0
ROUNDS = 12

# ASCII letters stay, any other ASCII byte separates words, bytes outside ASCII stay.
_LETTERS = np.array([b if chr(b).isalpha() else 32 for b in range(128)] + list(range(128, 256)), dtype=np.uint8)


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether the CRC-32 of the id as text falls in the fold that is not learnt from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def _words(array: pa.Array) -> Words:
    return Words(mapped(texts_lower(array), _LETTERS))


def texts_lower(array: pa.Array) -> pa.Array:
    return pa.concat_arrays([pc.utf8_lower(array)])


def _grams(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of each word with a space on either side, and where each word's start."""
    nothing, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    padded = pa.concat_arrays([pc.binary_join_element_wise(nothing, vocabulary, nothing, space)])
    offsets, data = raw(padded)
    codes = np.zeros(len(data), np.uint32)
    wide = data.astype(np.uint32)
    for j, prime in enumerate((1, 131, 17161)):  # powers of 131
        codes[: len(data) - j] += wide[j:] * np.uint32(prime)
    counts = np.maximum(np.diff(offsets) - 2, 0)
    starts = np.concatenate(([0], np.cumsum(counts)))
    at = np.repeat(offsets[:-1], counts) + np.arange(starts[-1]) - np.repeat(starts[:-1], counts)
    return (codes[at] * np.uint32(2654435761)) >> np.uint32(16), starts


def learn(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = ROWS_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """(languages in order, log probabilities [bucket, language]) from at most ``rows`` ids of each language.

    Rows without text or language are passed over. The table has ``BUCKETS`` rows whatever the input.
    """
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = scratch.keep(_chosen(labelled, id_col, lang_col, rows, scratch), "learnt")
    sample = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("words")).join(hinted(chosen, chosen.count()), ["id", "lang"], "left_semi")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        words = _words(texts(batch, "words"))
        langs = column(batch, "lang").dictionary_encode()
        grams, starts = _grams(words.vocabulary)
        if not len(words.codes):
            return None
        n_grams = np.diff(starts)
        rows = []
        of_word = np.asarray(langs.indices)[words.owner()]
        for number, name in enumerate(langs.dictionary.to_pylist()):
            often = np.bincount(words.codes[of_word == number], minlength=len(n_grams))
            sums = np.bincount(grams, weights=np.repeat(often, n_grams), minlength=BUCKETS)
            some = np.flatnonzero(sums)
            rows.append((pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(sums[some].astype(np.int64))))
        return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*rows, strict=True)], names=["lang", "bucket", "n"])

    counts = map_arrow(sample.select("lang", "words"), count, "lang string, bucket int, n long", "words").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counts.column("lang").to_pylist()))
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    place = {name: i for i, name in enumerate(languages)}
    np.add.at(table, (np.asarray(counts.column("bucket")), np.array([place[x] for x in counts.column("lang").to_pylist()], dtype=np.int64)), np.asarray(counts.column("n")))
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32)


def _chosen(labelled: DataFrame, id_col: str, lang_col: str, rows: int, scratch: Scratch) -> DataFrame:
    """(id, lang): of each language the ``rows`` ids with the least hashes.

    A histogram of the hashes' upper bits tells up to which of ``STRIPES`` stripes ids are needed, so that only about so many
    rows of a language are ever ranked in one task.
    """
    ids = scratch.keep(labelled.select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"), F.col(id_col).alias("id")).distinct(), "ids")
    stripe = F.shiftrightunsigned("h", 64 - STRIPES.bit_length() + 1).cast("int")
    sizes = ids.groupBy("lang", stripe.alias("stripe")).count().groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("stripe", "count"))).alias("sizes"))
    # the first stripe with which the languages' count reaches what is asked for
    sums = F.aggregate(
        "sizes", F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-1).alias("last")),
        lambda a, s: F.when(a["sum"] >= rows, a).otherwise(F.struct((a["sum"] + s["count"]).alias("sum"), s["stripe"].alias("last"))),
    )
    needed = scratch.keep(sizes.select(F.col("lang").alias("_lang"), sums["last"].alias("last")), "stripes")
    needed = hinted(needed, needed.count())
    few = ids.withColumn("stripe", stripe).join(needed, (F.col("lang") == F.col("_lang")) & (F.col("stripe") <= F.col("last")))
    order = Window.partitionBy("lang").orderBy("stripe", F.hex("h"), "id")
    return few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows).select("id", "lang")


def mixtures(array: pa.Array, table: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """Shares of the languages in each text, [text, language]; all zero for a text without a letter.

    A word is drawn from one language of the document's set, with the product of its trigram probabilities. The set grows
    by the language whose share would raise the likelihood fastest; EM then fits the shares; the set keeps growing while
    the log likelihood gains more than ``penalty`` times the logarithm of the number of words.
    """
    words = _words(array)
    n, languages = len(array), table.shape[1]
    out = np.zeros((n, languages))
    if not len(words.codes) or not languages:
        return out
    grams, starts = _grams(words.vocabulary)
    by_word = np.stack([np.add.reduceat(table[grams, k], starts[:-1]) for k in range(languages)], axis=1)
    lettered = np.asarray(pc.match_substring_regex(words.vocabulary, r"\p{L}"))
    codes = words.codes
    keep = lettered[codes]
    owner = words.owner()[keep]
    codes = codes[keep]
    counts = np.bincount(owner, minlength=n)
    docs = np.flatnonzero(counts)
    if not len(docs):
        return out
    counts = counts[docs]
    begins = np.concatenate(([0], np.cumsum(counts)))[:-1]
    log = by_word[codes]
    single = np.add.reduceat(log, begins, axis=0, dtype=np.float64)
    top = by_word.max(axis=1)
    p = np.exp(by_word - top[:, None])[codes]
    base = np.add.reduceat(top[codes], begins, dtype=np.float64)
    share = np.zeros((len(docs), languages))
    share[np.arange(len(docs)), single.argmax(axis=1)] = 1
    value = single.max(axis=1) - base
    at = np.repeat(np.arange(len(docs)), counts)
    open_docs = np.arange(len(docs))
    for _ in range(languages - 1):
        on = np.isin(at, open_docs) if len(open_docs) < len(docs) else np.ones(len(at), bool)
        local = np.searchsorted(open_docs, at[on])
        q = p[on]
        first = np.concatenate(([0], np.cumsum(counts[open_docs])))[:-1]
        pi = share[open_docs]
        slope = np.add.reduceat(q / np.maximum((q * pi[local]).sum(axis=1, keepdims=True), 1e-30), first, axis=0)
        slope[pi > 0] = -np.inf
        add = slope.argmax(axis=1)
        grows = slope[np.arange(len(open_docs)), add] > counts[open_docs]
        trial = np.where(pi > 0, pi * 0.8, 0)
        trial[np.arange(len(open_docs)), add] = 0.2
        for _ in range(rounds):
            weight = q * trial[local].astype(np.float32)
            total = np.maximum(weight.sum(axis=1, keepdims=True), 1e-30)
            trial = np.add.reduceat(weight / total, first, axis=0, dtype=np.float64) / counts[open_docs][:, None]
        total = np.maximum((q * trial[local].astype(np.float32)).sum(axis=1), 1e-30)
        reached = np.add.reduceat(np.log(total), first, dtype=np.float64)
        better = grows & (reached - value[open_docs] > penalty * np.log1p(counts[open_docs]))
        share[open_docs[better]], value[open_docs[better]] = trial[better], reached[better]
        open_docs = open_docs[better]
        if not len(open_docs):
            break
    out[docs] = share
    return out


def predict(
    docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str], text_col: str = "text", penalty: float = PENALTY, names: tuple[str, str, str] = ("lang_pred", "score", "shares")
) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` (the largest share; ties go to the first name), ``score`` (that share) and ``shares``.

    ``names`` are what the three are called; a kept column of such a name is left out.

    Null texts, texts without a letter and an empty model give ``und`` with score 0. Only the text is looked at.
    """
    languages, table = model
    keep = [c for c in keep if c not in names]
    sent = docs.sparkSession.sparkContext.broadcast(table)
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        shares = mixtures(texts(batch, text_col), sent.value, penalty)
        best = shares.argmax(axis=1) if languages else np.zeros(len(shares), int)
        score = shares.max(axis=1) if languages else np.zeros(len(shares))
        pred = [languages[b] if s > 0 else UNKNOWN for b, s in zip(best.tolist(), score.tolist(), strict=True)]
        found = [[(languages[k], float(row[k])) for k in np.flatnonzero(row)] for row in shares]
        arrays = [*(column(batch, c) for c in keep), pa.array(pred, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(found, pa.map_(pa.string(), pa.float64()))]
        return pa.RecordBatch.from_arrays(arrays, names=[*keep, *names])

    return map_arrow(docs.select(*dict.fromkeys([*keep, text_col])), run, f"{fields}, {names[0]} string, {names[1]} double, {names[2]} map<string,double>", text_col)
