"""Quality rules: counting rules, and how far a document's characters and common words lie from those of a language.

A language's reference is two histograms over all its documents: of character classes, and of its common words, those that
make up at least ``COMMON_SHARE`` of its words, beside all others. A language needs ``LANGUAGE_SHARE`` of all words to have
one. So there are at most 100 references of at most 1000 words, whatever the corpus holds, and they travel to the tasks; the
counts behind them cover every document. Distances are Jensen-Shannon distances (the root of the divergence to base 2, from
0 to 1). A document is held against every language and judged by the one whose common words lie nearest, so a wrong or
missing ``lang`` costs no clean document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import Words, column, map_arrow, raw, texts
from quayside.plans.session import Scratch

COMMON_SHARE = 1e-3
LANGUAGE_SHARE = 1e-2
# A text fails when its distance to the nearest language is above the limit, and the text is long enough to tell.
CLASS_LIMIT = 0.27
WORD_LIMIT = 0.5
MIN_CHARS = 200
MIN_WORDS = 50
# Base rules: fewer words than this, or more than half of them in repeated windows of three.
LEAST_WORDS = 50
REPEATED_SHARE = 0.5

# The character classes of a histogram.
CLASSES = ("vowel", "consonant", "capital", "digit", "space", "sentence mark", "symbol", "control", "two bytes", "three bytes", "four bytes")
_SYMBOLS = b"#*$%&|<>"
_MARKS = b".,;:!?'\"()-"


def _classes() -> np.ndarray:
    """The class of every byte; bytes inside a longer character have none (-1)."""
    of = np.full(256, 7, np.int8)
    of[0x80:0xC0] = -1
    of[0xC0:0xE0], of[0xE0:0xF0], of[0xF0:] = 8, 9, 10
    of[ord("a") : ord("z") + 1] = 1
    of[[*b"aeiou"]] = 0
    of[ord("A") : ord("Z") + 1] = 2
    of[ord("0") : ord("9") + 1] = 3
    of[[*b" \t\n\r\v\f"]] = 4
    printable = [c for c in range(0x21, 0x7F) if of[c] == 7]
    of[printable] = 6
    of[[*_MARKS]] = 5
    return of


_CLASS_OF = _classes()


@dataclass(frozen=True)
class References:
    """Histograms per language: ``classes`` (language x class), and the share of each common word."""

    languages: list[str]
    classes: np.ndarray
    words: list[dict[str, float]]


def _class_counts(array: pa.Array) -> np.ndarray:
    """Characters per class, one row per text."""
    offsets, data = raw(array)
    owner = np.repeat(np.arange(len(array)), np.diff(offsets))
    of = _CLASS_OF[data[offsets[0] : offsets[-1]]].astype(np.int64)
    inside = of >= 0
    width = len(CLASSES)
    return np.bincount(owner[inside] * width + of[inside], minlength=len(array) * width).reshape(len(array), width)


def _plain(vocabulary: pa.Array) -> pa.Array:
    """Words as they are looked up: lower case, without sentence marks around them."""
    return pc.ascii_trim(pc.utf8_lower(vocabulary), _MARKS.decode())


def learn(docs: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang") -> References:
    """The references of a corpus, counted over all its documents that have a text and a language.

    Without any such document there are no references, and ``judge`` then applies the counting rules alone.
    """
    schema = "lang string, class int, word string, n bigint"

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        names = column(batch, "lang")
        array = texts(batch, "text")
        out = []
        for name in pc.unique(names).to_pylist():
            some = array.filter(pc.equal(names, name))
            totals = _class_counts(some).sum(0)
            words = Words(some)
            plain = _plain(words.vocabulary).dictionary_encode()
            n = np.bincount(np.asarray(plain.indices)[words.codes], minlength=len(plain.dictionary)) if len(words.codes) else np.zeros(0, np.int64)
            k = len(plain.dictionary)
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * (len(CLASSES) + k), pa.string()),
                        pa.array([*range(len(CLASSES)), *[-1] * k], pa.int32()),
                        pa.concat_arrays([pa.nulls(len(CLASSES), pa.string()), plain.dictionary.cast(pa.string())]),
                        pa.array(np.concatenate([totals, n[:k]]), pa.int64()),
                    ],
                    names=["lang", "class", "word", "n"],
                )
            )
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if out else None

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).dropna()
    counts = scratch.keep(map_arrow(rows, count, schema, "text").groupBy("lang", "class", "word").agg(F.sum("n").alias("n")), "counts")
    sums = counts.where("class = -1").groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("words"))
    every = sums.agg(F.sum("words")).first()[0] or 0
    # at most 1 / LANGUAGE_SHARE rows pass, and 1 / COMMON_SHARE words of each
    great = sums.where(F.col("words") >= F.lit(LANGUAGE_SHARE * every)).select("of", "words")
    joined = counts.join(F.broadcast(great), counts["lang"] == great["of"])
    found = joined.where((F.col("class") >= 0) | (F.col("n") >= F.lit(COMMON_SHARE) * F.col("words"))).select("lang", "class", "word", "n", "words").collect()

    languages = sorted({r["lang"] for r in found})
    classes = np.zeros((len(languages), len(CLASSES)))
    words: list[dict[str, float]] = [{} for _ in languages]
    for r in found:
        at = languages.index(r["lang"])
        if r["class"] >= 0:
            classes[at, r["class"]] = r["n"]
        else:
            words[at][r["word"]] = r["n"] / r["words"]
    return References(languages, classes / np.maximum(classes.sum(1, keepdims=True), 1), words)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What each pair of shares adds to the Jensen-Shannon divergence to base 2."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / middle), 0)
        b = np.where(q > 0, q * np.log2(q / middle), 0)
    return (a + b) / 2


def _word_distances(words: Words, refs: References) -> np.ndarray:
    """Distance of each text's common-word histogram to each reference; 1 for a text without words."""
    n = len(words.counts)
    out = np.ones((n, len(refs.languages)))
    plain = _plain(words.vocabulary).cast(pa.string())
    owner = words.owner()
    some = words.counts > 0
    for at, shares in enumerate(refs.words):
        names = pa.array(list(shares), pa.string())
        q = np.array([*shares.values()])
        place = np.asarray(pc.fill_null(pc.index_in(plain, names), -1), dtype=np.int64)
        hit = place[words.codes] if len(words.codes) else np.zeros(0, np.int64)
        common = hit >= 0
        pair, count = np.unique(owner[common] * len(q) + hit[common], return_counts=True) if len(q) else (np.zeros(0, np.int64),) * 2
        doc, word = (pair // len(q), pair % len(q)) if len(q) else (pair, pair)
        p = count / words.counts[doc]
        # a reference word that the text lacks adds half its share: start from all, correct those met
        total = np.full(n, q.sum() / 2)
        total += np.bincount(doc, divergence(p, q[word]) - q[word] / 2, minlength=n)
        rest = 1 - np.bincount(doc, p, minlength=n)
        total += divergence(np.maximum(rest, 0), np.full(n, max(0.0, 1 - q.sum())))
        out[some, at] = np.sqrt(np.clip(total[some], 0, 1))
    return out


def _repeated_words(words: Words) -> np.ndarray:
    """Words per text inside windows of three that the text holds twice or more."""
    n, codes, owner = len(words.counts), words.codes.astype(np.int64), words.owner()
    if len(codes) < 3:
        return np.zeros(n, np.int64)
    first = np.flatnonzero(owner[:-2] == owner[2:])
    # two codes of a batch fit one number; the pair's rank with the third code fits another, and the text a third
    _, pair = np.unique(codes[first] * (codes.max() + 1) + codes[first + 1], return_inverse=True)
    _, triple = np.unique(pair * (codes.max() + 1) + codes[first + 2], return_inverse=True)
    _, key, times = np.unique(owner[first] * (triple.max(initial=0) + 1) + triple, return_inverse=True, return_counts=True)
    again = first[times[key] > 1]
    marked = np.zeros(len(codes), bool)
    for j in range(3):
        marked[again + j] = True
    return np.bincount(owner[marked], minlength=n)


def _repeated_lines(array: pa.Array) -> np.ndarray:
    """Lines per text that hold a word and equal an earlier line of the text."""
    lines = pc.split_pattern(array, "\n")
    owner = np.asarray(pc.list_parent_indices(lines), dtype=np.int64)
    values = pc.list_flatten(lines)
    full = np.asarray(pc.match_substring_regex(values, r"[^\x20\x09-\x0D]"))
    code = np.asarray(values.dictionary_encode().indices, dtype=np.int64)[full]
    owner = owner[full]
    pair = owner * (code.max(initial=0) + 1) + code
    _, first = np.unique(pair, return_index=True)
    return np.bincount(owner, minlength=len(array)) - np.bincount(owner[first], minlength=len(array))


FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, "
    "language string, class_distance double, word_distance double"
)


def judge(docs: DataFrame, refs: References, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its counts, its distances to the nearest language, and whether it is kept.

    A null text counts as one without words; it fails the base rules like every text under ``LEAST_WORDS`` words. Repeated
    rows and ids each keep their row. Texts under ``MIN_CHARS`` characters in words are not judged by their characters, those
    under ``MIN_WORDS`` words not by their common words. Without references both distances are null and only the base rules
    count. Lines end at a line feed.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        array = texts(batch, "text")
        words = Words(array)
        n = len(array)
        classes = _class_counts(array)
        lengths = np.asarray(pc.utf8_length(words.values), dtype=np.int64)
        chars = np.bincount(words.owner(), lengths, minlength=n).astype(np.int64)
        offsets, data = raw(array)
        symbol = np.isin(data[offsets[0] : offsets[-1]], np.frombuffer(_SYMBOLS, np.uint8))
        before = np.concatenate(([0], np.cumsum(symbol)))
        symbols = np.diff(before[offsets - offsets[0]])
        again = _repeated_words(words)
        failed = (words.counts < LEAST_WORDS) | (again > REPEATED_SHARE * words.counts)
        kept = ~failed
        known = len(refs.languages) > 0
        if known:
            by_word = _word_distances(words, refs)
            nearest = by_word.round(9).argmin(1)  # the first of languages equally far
            word_distance = by_word[np.arange(n), nearest]
            total = classes.sum(1, keepdims=True)
            class_distance = np.sqrt(np.clip(divergence(classes / np.maximum(total, 1), refs.classes[nearest]).sum(1), 0, 1))
            kept &= (class_distance <= CLASS_LIMIT) | (chars < MIN_CHARS)
            kept &= (word_distance <= WORD_LIMIT) | (words.counts < MIN_WORDS)
        return pa.RecordBatch.from_arrays(
            [
                column(batch, "key"),
                *[pa.array(x, pa.int64()) for x in (words.counts, chars, symbols, _repeated_lines(array), again)],
                pa.array(failed),
                pa.array(kept),
                pa.array([refs.languages[i] for i in nearest], pa.string()) if known else pa.nulls(n, pa.string()),
                pa.array(class_distance, pa.float64()) if known else pa.nulls(n, pa.float64()),
                pa.array(word_distance, pa.float64()) if known else pa.nulls(n, pa.float64()),
            ],
            names=["key", *[f.split()[0] for f in FIELDS.split(", ")]],
        )

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    found = map_arrow(rows, one, f"key {rows.schema['key'].dataType.simpleString()}, {FIELDS}", "text")
    return found.withColumnRenamed("key", key)
