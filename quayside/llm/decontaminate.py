"""Benchmark passages inside documents: SimHash over item-sized windows, Hamming blocks, exact weighted-shingle check."""

from __future__ import annotations

import uuid
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import Words, column, doc_ids_type, hash64, map_arrow, mapped, mix, shingle_hashes, shingle_seed, shingle_step, texts
from quayside.plans.session import Scratch, hinted

WIDTH = 5
THRESHOLD = 0.8
# Fingerprints within this many of 64 bits are candidates: passages at the threshold differ in about 10, three standard deviations are 9.
RADIUS = 19
BLOCKS = 5
# Where the blocks of a fingerprint begin and end.
_CUTS = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
# Items that go to the tasks at a time; more items mean more passes over the documents.
ITEMS_PER_PASS = 10_000
BYTES_PER_PASS = 32_000_000
# Text fingerprinted at a time: running counts take 128 bytes a word where passages are dense.
SLICE = 2_000_000

# Lower-cased ASCII letters and digits, and all bytes outside ASCII; any other ASCII byte separates words.
_FOLD = np.array([ord(chr(b).lower()) if b >= 128 or chr(b).isalnum() else 32 for b in range(128)] + list(range(128, 256)), dtype=np.uint8)


def _word_hashes(words: Words) -> np.ndarray:
    return hash64(words.vocabulary, 42)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)


def _simhash(bits_before: np.ndarray, start: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Fingerprints of the windows of ``size`` shingles at ``start``; ``bits_before`` counts the ones before each shingle."""
    ones = bits_before[start + size] - bits_before[start]
    return np.packbits(ones > np.reshape(size, (-1, 1)) // 2, axis=1, bitorder="little").view("<u8").ravel()


def _ones_before(hashes: np.ndarray, longest: int) -> np.ndarray:
    """Running counts of the ones of each bit; they may wrap, as only differences over at most ``longest`` rows are used."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(hashes) + 1, 64), np.uint16 if longest < 1 << 16 else np.uint32)
    np.cumsum(bits, axis=0, out=out[1:], dtype=out.dtype)
    return out


class Items:
    """The benchmark items of one pass: their shingles, and for each window size a multi-index over their fingerprints.

    A fingerprint is cut into ``BLOCKS`` blocks. Within ``radius`` bits in all, some block is within ``radius // BLOCKS``
    bits, so a table of every block value that near an item's block holds all items a window has to be compared with.
    """

    def __init__(self, ids: pa.Array, array: pa.Array, width: int = WIDTH, radius: int = RADIUS) -> None:
        self.width, self.radius = width, radius
        words = Words(mapped(array, _FOLD))
        hashes, starts = shingle_hashes(_word_hashes(words), words.starts, width)
        vocabulary = np.array(words.vocabulary.to_pylist(), dtype=object)
        self.ids = ids
        self.words = [vocabulary[words.codes[a:b]].tolist() for a, b in zip(words.starts, words.starts[1:], strict=False)]
        self.known = np.unique(hashes)
        before = _ones_before(hashes, int(words.counts.max(initial=1)))
        by_size: dict[int, list[int]] = {}
        for i, n in enumerate(words.counts.tolist()):
            if n:
                by_size.setdefault(n, []).append(i)
        self.sizes = {}
        for n, members in by_size.items():
            members = np.array(members)
            prints = _simhash(before, starts[members], max(n - width + 1, 1))
            self.sizes[n] = (members, prints, [_block_table(prints, b, radius // BLOCKS) for b in range(BLOCKS)])


def _block(prints: np.ndarray, block: int) -> np.ndarray:
    return ((prints >> np.uint64(_CUTS[block])) & np.uint64((1 << (_CUTS[block + 1] - _CUTS[block])) - 1)).astype(np.int64)


def _block_table(prints: np.ndarray, block: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, members): which of ``prints`` have a value within ``reach`` bits of v in this block, for each v."""
    own, step = _block(prints, block), _CUTS[block + 1] - _CUTS[block]
    masks = np.array([sum(1 << b for b in c) for k in range(reach + 1) for c in combinations(range(step), k)], dtype=np.int64)
    values = (own[:, None] ^ masks).ravel().astype(np.uint16)
    order = np.argsort(values, kind="stable")
    offsets = np.concatenate(([0], np.cumsum(np.bincount(values, minlength=1 << step))))
    return offsets, (order // len(masks)).astype(np.int32)


def _candidates(prints: np.ndarray, size: tuple, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item number in this size) of all pairs within ``radius`` bits."""
    members, own, tables = size
    found = []
    for b, (offsets, rows) in enumerate(tables):
        value = _block(prints, b)
        n = offsets[value + 1] - offsets[value]
        window = np.repeat(np.arange(len(prints)), n)
        item = rows[np.repeat(offsets[value], n) + np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)]
        near = np.bitwise_count(prints[window] ^ own[item]) <= radius
        found.append(window[near] * len(members) + item[near])
    pair = np.unique(np.concatenate(found))
    return pair // len(members), pair % len(members)


def similarity(a: list[str], b: list[str], width: int = WIDTH) -> float:
    """Weighted Jaccard of two word lists: shingles weigh as often as they occur, shared weight over total weight."""
    bags = [Counter(tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))) for w in (a, b)]
    shared = sum((bags[0] & bags[1]).values())
    return shared / (sum(bags[0].values()) + sum(bags[1].values()) - shared)


class _Shingles:
    """The shingles of one width in a batch, by their first word, with the counts that window fingerprints come from.

    Only places close enough to a shingle that some item has are counted: every window that holds one lies there.
    """

    def __init__(self, word_hash: np.ndarray, owner: np.ndarray, width: int, items: Items) -> None:
        n = len(word_hash)
        hashes = np.full(n, shingle_seed(width))
        for j in range(min(width, n)):
            hashes[: n - j] = shingle_step(hashes[: n - j], word_hash[j:])
        hashes = mix(hashes)
        whole = np.zeros(n, bool)
        whole[: max(n - width + 1, 0)] = owner[: max(n - width + 1, 0)] == owner[width - 1 :]
        spot = np.minimum(np.searchsorted(items.known, hashes), len(items.known) - 1)
        self.known = whole & (items.known[spot] == hashes)
        self.hits = np.flatnonzero(self.known)
        self.known_before = np.concatenate(([0], np.cumsum(self.known)))
        longest = max(size - width + 1 for size in items.sizes if min(size, items.width) == width)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, np.maximum(self.hits - longest, 0), 1)
        np.add.at(edge, np.minimum(self.hits + longest + 1, n), -1)
        kept = np.cumsum(edge[:n]) > 0
        self.rank = np.concatenate(([0], np.cumsum(kept)))
        self.before = _ones_before(hashes[kept], longest)


def find(array: pa.Array, items: Items, threshold: float = THRESHOLD) -> list[tuple[int, int, int, int, int, float]]:
    """(text, item, first word, words, differing bits, similarity): the best window of every text and item that match.

    Windows slide word by word, one size per item size. A text with fewer words than the item is one window, if it has
    shingles enough to reach the threshold. A window without any shingle of any item has similarity 0 to all of them, so
    only the others get a fingerprint. The best is the most similar, then the nearest, then the first.
    """
    words = Words(mapped(array, _FOLD))
    if not len(words.codes) or not items.sizes:
        return []
    word_hash, owner = _word_hashes(words), words.owner()
    vocabulary: list[str] = []
    shingles: dict[int, _Shingles] = {}
    best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
    for n, size in items.sizes.items():
        width = min(n, items.width)
        if width not in shingles:
            shingles[width] = _Shingles(word_hash, owner, width, items)
        s, span = shingles[width], n - width + 1
        if not len(s.hits):
            continue
        edge = np.zeros(len(owner) + 1, np.int64)
        np.add.at(edge, np.maximum(s.hits - span + 1, 0), 1)
        np.add.at(edge, s.hits + 1, -1)
        start = np.flatnonzero(np.cumsum(edge[: max(len(owner) - n + 1, 0)]) > 0)
        start = start[owner[start] == owner[start + n - 1]]
        whole = np.flatnonzero((words.counts < n) & (words.counts >= width) & (words.counts - width + 1 >= threshold * span - 1e-9))
        whole = whole[s.known_before[words.starts[whole + 1] - width + 1] > s.known_before[words.starts[whole]]]
        many = np.concatenate((np.full(len(start), n), words.counts[whole]))
        start, spans = np.concatenate((start, words.starts[whole])), many - width + 1
        # shingles that no item has are not shared: an upper bound of the similarity before the exact one
        hopeful = s.known_before[start + spans] - s.known_before[start] >= threshold * span - 1e-9
        start, spans, many = start[hopeful], spans[hopeful], many[hopeful]
        if not len(start):
            continue
        prints = _simhash(s.before, s.rank[start], spans)
        window, item = _candidates(prints, size, items.radius)
        for w, i in zip(window.tolist(), item.tolist(), strict=True):
            vocabulary = vocabulary or words.vocabulary.to_pylist()
            first, number, long = int(start[w]), int(size[0][i]), int(many[w])
            value = similarity([vocabulary[c] for c in words.codes[first : first + long].tolist()], items.words[number], items.width)
            if value >= threshold:
                text = int(owner[first])
                mark = (-value, int(np.bitwise_count(prints[w] ^ size[1][i])), first - int(words.starts[text]), long)
                best[text, number] = min(mark, best.get((text, number), mark))
    return [(text, number, first, n, bits, -value) for (text, number), (value, bits, first, n) in sorted(best.items())]


def leaks(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    width: int = WIDTH, threshold: float = THRESHOLD, radius: int = RADIUS,
) -> DataFrame:
    """``(<id_col>, <item_col>, first_word, n_words, differing_bits, similarity)`` of every document and item that match.

    A document matches an item when a window of as many words as the item, or the whole text if it has fewer, has a
    weighted ``width``-word shingle similarity of ``threshold`` or more and a fingerprint within ``radius`` bits. Words are runs of letters, digits and
    non-ASCII bytes, A-Z folded; an item of fewer words than ``width`` is one shingle. Null and empty texts and items
    match nothing. Repeated rows of documents give repeated rows; repeated items count each. Other columns are ignored.
    Items go to the tasks in blocks of at most ``ITEMS_PER_PASS`` rows and ``BYTES_PER_PASS`` bytes, one pass each.
    """
    items = scratch.keep(benchmark.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(item_text_col).alias("words")), "items")
    rows, total = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    passes = max(-(-rows // ITEMS_PER_PASS), -(-total // BYTES_PER_PASS), 1)
    schema = f"{id_col} {doc_ids_type(docs, id_col)}, {item_col} {doc_ids_type(benchmark, item_col)}, first_word long, n_words long, differing_bits int, similarity double"
    context = docs.sparkSession.sparkContext
    found = None
    for part in range(passes):
        block = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(passes)) == part).orderBy("item", "words").toArrow()
        sent = context.broadcast((block.column("item").combine_chunks(), block.column("words").cast(pa.large_string()).combine_chunks()))

        def run(batch: pa.RecordBatch, sent=sent, name=uuid.uuid4().hex) -> pa.RecordBatch | None:
            items = _items(name, sent, width, radius)
            rows = find(texts(batch, text_col), items, threshold)
            if not rows:
                return None
            text, number, first, n, bits, value = zip(*rows, strict=True)
            arrays = [
                column(batch, id_col).take(pa.array(text)), items.ids.take(pa.array(number)), pa.array(first, pa.int64()), pa.array(n, pa.int64()),
                pa.array(bits, pa.int32()), pa.array(value, pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=[id_col, item_col, "first_word", "n_words", "differing_bits", "similarity"])

        one = map_arrow(docs.select(id_col, text_col), run, schema, text_col, SLICE)
        found = one if found is None else found.unionByName(one)
    return found


_built: dict[str, Items] = {}
_KEY = "__leak_key"


def _items(name: str, sent, width: int, radius: int) -> Items:
    """The index of the broadcast block of this name, built once per Python worker."""
    if name not in _built:
        _built.clear()
        _built[name] = Items(*sent.value, width, radius)
    return _built[name]


def without_leaks(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text matches no benchmark item.

    Rows go by id and text, so a clean row stays whatever other rows share its id, a null one too.
    """
    key = F.md5(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))]))
    keyed = docs.select(key.alias(_KEY), text_col)
    found = scratch.keep(leaks(keyed, benchmark, scratch, _KEY, text_col, **options).select(_KEY).distinct(), "leaks")
    return docs.join(hinted(found, found.count()), key == found[_KEY], "left_anti").select(*docs.columns)
