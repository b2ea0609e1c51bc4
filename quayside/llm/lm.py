"""An n-gram language model in an Elias-Fano trie, and document scores under it and under token counts."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.batches import Words, column, doc_ids_type, hash64, map_arrow, mix, raw, release, slices, texts
from quayside.llm.files import written
from quayside.plans.session import Scratch

# A text as symbols: a line feed, then the bytes of each word and a space after it, then a line feed for the end.
ORDER = 7
SPACE, END = 32, 10
# Symbols before a word that its first ones depend on.
BEFORE = 3
# An n-gram stays in the trie if it occurs this often; there is no other bound, so the trie grows with the corpus.
LEAST = 2
# About how many n-grams a part of the trie has; a task builds one at a time.
PART_ROWS = 2_000_000
# Steps per factor of two in stored probabilities.
STEPS = 1024
# Tokens whose counts travel to every task; picked from a sample, all others go by shuffle. Both ways give exact counts.
FREQUENT = 100_000
SAMPLE_DOCS = 4000
_TOKEN, _TOTAL = 0, 100
SLICE = 1_500_000
# N-grams that a task counts together before it hands them on.
HELD = 2_000_000
# Rows of them in one Arrow batch.
SENT = 100_000
# Places, two to this power, in which a worker remembers costs of n-grams.
REMEMBERED = 21


def held_out(id_col: str, folds: int = 7, fold: int = 2) -> Column:
    """Whether the CRC-32 of the id as text falls in the fold that is not learnt from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


# --- Elias-Fano -----------------------------------------------------------------------------------------------------

_EACH_BYTE = np.uint64(0x0101010101010101)
_SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for k in range(8)] for b in range(256)], dtype=np.uint8)


def ef_arrays(values: np.ndarray) -> dict[str, np.ndarray]:
    """A non-decreasing sequence in Elias-Fano form: low bits packed, high bits in unary, ones counted before each word."""
    n = len(values)
    top = int(values[-1]) + 1 if n else 1
    width = max(0, int(math.floor(math.log2(top / n)))) if n else 0
    low = np.zeros(n * width // 8 + 9, np.uint8)
    if width:
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        low[: len(packed)] = packed
    place = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    words = np.zeros((int(place[-1]) if n else 0) // 64 + 1, np.uint64)
    np.bitwise_or.at(words, place // 64, np.uint64(1) << (place % 64).astype(np.uint64))
    ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words)))).astype(np.uint32)
    return {"width": np.array([width], np.uint64), "low": low, "high": words, "ones": ones}


class EliasFano:
    """Random access into such a sequence, for many places at once."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.width = int(arrays["width"][0])
        low = arrays["low"]
        self.low = np.ndarray(shape=(len(low) - 7,), dtype="<u8", buffer=low, strides=(1,))
        self.high, self.ones = arrays["high"], arrays["ones"]

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, at, side="right") - 1
        left = at.astype(np.uint64) - self.ones[word]
        bits = self.high[word]
        # ones up to the end of each byte of the word, side by side; then the bytes that end before the wanted one
        ones = bits - ((bits >> np.uint64(1)) & np.uint64(0x5555555555555555))
        ones = (ones & np.uint64(0x3333333333333333)) + ((ones >> np.uint64(2)) & np.uint64(0x3333333333333333))
        ones = ((ones + (ones >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH_BYTE
        earlier = ((left * _EACH_BYTE) | (_EACH_BYTE << np.uint64(7))) - ones
        shift = np.bitwise_count(earlier & (_EACH_BYTE << np.uint64(7))).astype(np.uint64) << np.uint64(3)
        left -= ((ones << np.uint64(8)) >> shift) & np.uint64(255)
        found = word * 64 + shift.astype(np.int64) + _SELECT[((bits >> shift) & np.uint64(255)).astype(np.int64), left.astype(np.int64)]
        high = (found - at).astype(np.uint64) << np.uint64(self.width)
        if not self.width:
            return high.astype(np.int64)
        bit = at * self.width
        low = (self.low[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)
        return (high | low).astype(np.int64)


# --- the trie -------------------------------------------------------------------------------------------------------
#
# Orders 1 and 2 are plain tables over all bytes and pairs of bytes. N-grams of three symbols and more are dealt by their first
# three symbols to parts, each a trie of its own under the 65,536 pairs, so that a part is built by one task from its own rows.


def _mask(k: int) -> np.uint64:
    return np.uint64((1 << (8 * k)) - 1)


def part_of(lead, parts: int):
    """The part of an n-gram by its first three symbols as an integer: a number, an array or a Column."""
    return lead * 2654435761 % 2147483647 % parts


def _stored(p: np.ndarray) -> np.ndarray:
    """-log2 in steps, rounded up, so that no probability gets more than its due; the least that fits is 2 ** -63."""
    return np.minimum(np.ceil(-np.log2(p) * STEPS - 1e-6), 65535).astype(np.uint16)


def _packed(arrays: dict[str, np.ndarray]) -> bytes:
    head, at, parts = {}, 0, []
    for name, a in arrays.items():
        data = a.tobytes()
        head[name] = (a.dtype.str, len(a), at)
        parts.append(data + bytes(-len(data) % 8))
        at += len(parts[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(parts)


def _mapped(path: str) -> dict[str, np.ndarray]:
    data = np.memmap(path, dtype=np.uint8, mode="r")
    size = int.from_bytes(data[:8].tobytes(), "little")
    told = json.loads(data[8 : 8 + size].tobytes())
    return {name: data[8 + size + at : 8 + size + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, n, at) in told.items()}


def low_orders(k: np.ndarray, gram: np.ndarray, own: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Probabilities of all 256 bytes, then of all pairs of bytes, from the rows of orders 1 and 2 as ``smoothed`` takes them."""
    one = np.full(256, 1 / 256)
    on = k == 1
    if on.any():
        one *= rest[on][0]
        one[gram[on]] += own[on]
    on = k == 2
    left = np.ones(256)
    left[gram[on] >> 8] = rest[on]
    two = left[:, None] * one[None, :]
    two[gram[on] >> 8, gram[on] & 255] += own[on]
    return np.concatenate((one, two.ravel()))


def smoothed(k: np.ndarray, gram: np.ndarray, own: np.ndarray, rest: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Interpolated Witten-Bell probabilities of n-grams of three symbols and more; of each, all its endings must be given too.

    P(s | c) = (n(cs) + (T(c) + counts pruned under c) P(s | shorter c)) / (N(c) + T(c)); ``own`` is the part of n(cs), ``rest``
    the factor of the shorter context's probability.
    """
    p = np.zeros(len(k))
    gram = gram.astype(np.uint64)
    before = before_p = None
    for order in range(3, ORDER + 1):
        on = np.flatnonzero(k == order)
        on = on[np.argsort(gram[on])]
        ending = gram[on] & _mask(order - 1)
        if order == 3:
            lower = low[256 + ending.astype(np.int64)]
        else:
            at = np.minimum(np.searchsorted(before, ending), max(len(before) - 1, 0))
            if len(on) and not (len(before) and (before[at] == ending).all()):
                raise ValueError("an n-gram's ending is not in the model")
            lower = before_p[at] if len(on) else np.zeros(0)
        p[on] = own[on] + rest[on] * lower
        before, before_p = gram[on], p[on]
    return p


def build_head(low: np.ndarray, pairs: np.ndarray, rest: np.ndarray) -> bytes:
    """The file of orders 1 and 2, and what each pair of symbols leaves to shorter contexts."""
    left = np.zeros(1 << 16, np.uint16)
    left[pairs] = _stored(rest)
    return _packed({"cost1": _stored(low[:256]), "cost2": _stored(low[256:]), "rest2": left})


def build_part(k: np.ndarray, gram: np.ndarray, cost: np.ndarray, rest: np.ndarray) -> bytes:
    """The file of one part from its n-grams, their costs and what their contexts leave, all rows of one order ascending."""
    arrays: dict[str, np.ndarray] = {}
    before = np.arange(1 << 16, dtype=np.uint64)
    for order in range(3, ORDER + 1):
        on = np.flatnonzero(k == order)
        grams = gram[on].astype(np.uint64)
        parent = np.searchsorted(before, grams >> np.uint64(8))
        if not ((parent < len(before)).all() and (before[parent] == grams >> np.uint64(8)).all()):
            raise ValueError("an n-gram's context is not in the trie")
        pointers = np.searchsorted(parent, np.arange(len(before) + 1))
        symbol = (grams & np.uint64(255)).astype(np.int64)
        # each context's symbols are counted on from where the one before it ended, which makes the level increase
        last = np.append(np.diff(parent) > 0, True) if len(on) else np.zeros(0, bool)
        steps = np.where(last, symbol + 1, 0)
        base = np.cumsum(steps) - steps
        level = base[pointers[:-1][parent]] + symbol if len(on) else symbol
        arrays[f"cost{order}"] = cost[on].astype(np.uint16)
        if order > 3:
            left = np.zeros(len(before), np.uint16)
            left[parent] = rest[on]
            arrays[f"rest{order - 1}"] = left
        arrays |= {f"pointers{order}.{x}": a for x, a in ef_arrays(pointers.astype(np.uint64)).items()}
        arrays |= {f"symbols{order}.{x}": a for x, a in ef_arrays(level.astype(np.uint64)).items()}
        before = grams
    return _packed(arrays)


class Part:
    """One part's file, memory-mapped. A node is an n-gram's place in its level; those of order 2 are the pairs themselves."""

    def __init__(self, path: str, rest2: np.ndarray) -> None:
        arrays = _mapped(path)
        self.cost = {k: arrays[f"cost{k}"] for k in range(3, ORDER + 1)}
        self.rest = {2: rest2} | {k: arrays[f"rest{k}"] for k in range(3, ORDER)}
        level = lambda name: EliasFano({x: arrays[f"{name}.{x}"] for x in ("width", "low", "high", "ones")})
        self.pointers = {k: level(f"pointers{k}") for k in range(3, ORDER + 1)}
        self.symbols = {k: level(f"symbols{k}") for k in range(3, ORDER + 1)}

    def child(self, k: int, parent: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Node of order k under each parent (of order k - 1) with this symbol, -1 for none."""
        pointers, level = self.pointers[k], self.symbols[k]
        out = np.full(len(parent), -1, np.int64)
        begin, end = pointers[parent], pointers[parent + 1]
        some = np.flatnonzero(end > begin)
        if not len(some):
            return out
        begin, end = begin[some], end[some]
        base = np.where(begin > 0, level[np.maximum(begin - 1, 0)] + 1, 0)
        wanted = base + symbol[some]
        low, high = begin.copy(), end.copy()
        while (on := np.flatnonzero(low < high)).size:
            mid = (low[on] + high[on]) // 2
            less = level[mid] < wanted[on]
            low[on] = np.where(less, mid + 1, low[on])
            high[on] = np.where(less, high[on], mid)
        hit = low < end
        hit[hit] = level[low[hit]] == wanted[hit]
        out[some[hit]] = low[hit]
        return out

    def find(self, k: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cost, found) of ascending n-grams of order k; of one not found, the cost is what its context leaves."""
        node = (grams >> np.uint64(8 * (k - 2))).astype(np.int64)
        for j in range(3, k + 1):
            prefix = grams >> np.uint64(8 * (k - j))
            new = np.append(True, prefix[1:] != prefix[:-1])
            first, which = np.flatnonzero(new), np.cumsum(new) - 1
            parent = node[first]
            child = np.full(len(first), -1, np.int64)
            on = np.flatnonzero(parent >= 0)
            child[on] = self.child(j, parent[on], (prefix[first[on]] & np.uint64(255)).astype(np.int64))
            parents, node = node, child[which]
        cost = np.zeros(len(grams), np.int64)
        found = node >= 0
        cost[found] = self.cost[k][node[found]]
        left = np.flatnonzero(~found & (parents >= 0))
        cost[left] = self.rest[k - 1][parents[left]]
        return cost, found


class Trie:
    """The head and the parts (by number; parts without n-grams have no file)."""

    def __init__(self, head: str, parts: dict[int, str], of: int) -> None:
        arrays = _mapped(head)
        self.cost1, self.cost2 = arrays["cost1"], arrays["cost2"]
        self.parts, self.of = {i: Part(path, arrays["rest2"]) for i, path in parts.items()}, of

    def find(self, k: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As of a part, each n-gram in its own."""
        cost, found = np.zeros(len(grams), np.int64), np.zeros(len(grams), bool)
        part = part_of((grams >> np.uint64(8 * (k - 3))).astype(np.int64), self.of)
        order = np.argsort(part, kind="stable")
        begins = np.searchsorted(part[order], np.arange(self.of + 1))
        for i, known in self.parts.items():
            on = order[begins[i] : begins[i + 1]]
            if len(on):
                cost[on], found[on] = known.find(k, grams[on])
        return cost, found

    def gram_costs(self, keys: np.ndarray) -> np.ndarray:
        """-log2 of the probability of the last symbol of each n-gram after the others; n-grams as ``_keys`` makes them.

        The longest ending that the trie holds has the cost stored; each longer context that it holds adds what it leaves.
        """
        length = (keys >> np.uint64(56)).astype(np.int64)
        out = np.zeros(len(keys), np.int64)
        open_ = np.arange(len(keys))
        for k in range(ORDER, 2, -1):
            long = length[open_] >= k
            on = open_[long]
            if len(on):
                grams, back = np.unique(keys[on] & _mask(k), return_inverse=True)
                cost, found = self.find(k, grams)
                out[on] += cost[back]
                open_ = np.concatenate((open_[~long], on[~found[back]]))
        pair = (keys[open_] & np.uint64(0xFFFF)).astype(np.int64)
        out[open_] += np.where(length[open_] > 1, self.cost2[pair].astype(np.int64), self.cost1[pair & 255].astype(np.int64))
        return out / STEPS


# --- counting and scoring -------------------------------------------------------------------------------------------


class _Batch:
    """Tokens of a batch. ``hashes`` are those of the words; the last token of a text, its end, has the code after theirs.

    ``units`` are the different pairs of a token and the ``BEFORE`` symbols before it, and ``of`` is each token's unit.
    """

    def __init__(self, array: pa.Array) -> None:
        self.words = Words(pc.ascii_lower(array))
        self.hashes = hash64(self.words.vocabulary, 1).view(np.int64)

    def units(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, place of each in its unit or -1 before its text, where units start, unit of each token in order)."""
        words = self.words
        n, docs = len(self.hashes), len(words.counts)
        codes = np.full(len(words.codes) + docs, n, np.int64)
        first = words.starts[:-1] + np.arange(docs)
        ends = words.starts[1:] + np.arange(docs)
        is_word = np.ones(len(codes), bool)
        is_word[ends] = False
        codes[is_word] = words.codes
        offsets, data = raw(pa.concat_arrays([words.vocabulary]))
        length = np.diff(offsets)
        last = data[offsets[1:] - 1].astype(np.int64)
        second = np.where(length > 1, data[np.maximum(offsets[1:] - 2, 0)], SPACE).astype(np.int64)
        # the last two bytes of the token before; one that starts its text shows the line feed when it is a single byte
        pair = np.zeros(len(codes), np.int64)
        before = codes[:-1] % max(n, 1) if n else codes[:-1]
        lead = second[before] if n else before
        opens = np.zeros(len(codes), bool)
        opens[first] = True
        if n:
            lead = np.where(opens[:-1] & (length[before] == 1), END, lead)
            pair[1:] = lead * 256 + last[before]
        pair[first] = 1 << 16
        key, of = np.unique(pair * (n + 1) + codes, return_inverse=True)
        code, pair = key % (n + 1), key // (n + 1)
        starts_text = pair == 1 << 16
        own = np.where(code < n, np.append(length, 0)[code], 0)
        sizes = BEFORE + own + 1
        begins = np.concatenate(([0], np.cumsum(sizes)))
        out = np.full(begins[-1], SPACE, np.uint8)
        out[begins[:-1]] = np.where(starts_text, 0, pair >> 8)
        out[begins[:-1] + 1] = np.where(starts_text, SPACE, pair & 255)
        out[begins[:-1] + 2] = np.where(starts_text, END, SPACE)
        at = np.repeat(begins[:-1] + BEFORE - (np.cumsum(own) - own), own) + np.arange(own.sum())
        out[at] = data[np.repeat(np.append(offsets[:-1], 0)[code] - (np.cumsum(own) - own), own) + np.arange(own.sum())]
        out[begins[1:][code == n] - 1] = END
        place = np.arange(len(out)) - np.repeat(begins[:-1] + starts_text, sizes)
        return out, place, begins, of


def _own(begins: np.ndarray) -> np.ndarray:
    """The symbols of units that are not those before the word."""
    out = np.ones(begins[-1], bool)
    for j in range(BEFORE):
        out[begins[:-1] + j] = False
    return np.flatnonzero(out)


_ENDINGS = np.array([(1 << (8 * k)) - 1 for k in range(ORDER + 1)], np.uint64)


def _keys(data: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The n-grams of the highest order that end at these places, as integers with their length in the top byte."""
    grams = data.astype(np.uint64)
    for j in (1, 2, 4):  # of two symbols, of four, of eight
        grams[j:] |= grams[:-j] << np.uint64(8 * j)
    length = np.minimum(place[at] + 1, ORDER)
    return (grams[at] & _ENDINGS[length]) | (length.astype(np.uint64) << np.uint64(8 * ORDER))


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of what stands by each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(n[order], first) if len(keys) else n


def _counted(batches: Iterable[pa.RecordBatch], text_col: str, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(kind, key, n)`` of a task's texts, counted together until about ``HELD`` different n-grams have come."""
    often, total = np.zeros(len(frequent), np.int64), np.zeros(2, np.int64)
    keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for part in slices(batch, text_col, SLICE):
            b = _Batch(texts(part, text_col))
            total += len(b.words.codes) + part.num_rows, part.num_rows
            if len(frequent) and len(b.hashes):
                at = np.minimum(np.searchsorted(frequent, b.hashes), len(frequent) - 1)
                hit = frequent[at] == b.hashes
                often[at[hit]] += np.bincount(b.words.codes, minlength=len(b.hashes))[hit]
            data, place, begins, of = b.units()
            on = _own(begins)
            waiting.append(_summed(_keys(data, place, on), np.repeat(np.bincount(of, minlength=len(begins) - 1), np.diff(begins))[on]))
            if sum(len(k) for k, _ in waiting) >= HELD:
                keys, n = _summed(*(np.concatenate(c) for c in zip((keys, n), *waiting, strict=True)))
                waiting = []
                if len(keys) >= HELD:
                    yield from _rows(keys, n)
                    keys, n = keys[:0], n[:0]
    if total.any():
        yield from _rows(*_summed(*(np.concatenate(c) for c in zip((keys, n), *waiting, strict=True))))
        some = np.flatnonzero(often)
        kind = np.append(np.full(len(some), _TOKEN, np.int32), np.array([_TOTAL, _TOTAL + 1], np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.append(frequent[some], [0, 0])), pa.array(np.append(often[some], total))], names=["kind", "key", "n"])
    release()


def _rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    kind, key = (keys >> np.uint64(8 * ORDER)).astype(np.int32), (keys & _mask(ORDER)).view(np.int64)
    whole = pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key), pa.array(n)], names=["kind", "key", "n"])
    for begin in range(0, len(keys), SENT):
        yield whole.slice(begin, SENT)


def count(docs: DataFrame, frequent: np.ndarray, text_col: str) -> DataFrame:
    """``(kind, key, n)`` over all rows: n-grams (kind: their length), frequent words (0, their hash), tokens and rows (100)."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)
    counted = docs.select(text_col).mapInArrow(lambda batches: _counted(batches, text_col, sent.value), "kind int, key long, n long")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """Names of the model's files in the scratch folder, and as every executor gets them once shared."""

    head: str
    parts: dict[int, str]
    of: int


def _whole_groups(batches: Iterable[pa.RecordBatch], group: str, names: list[str], apart: bool) -> Iterator[list[np.ndarray]]:
    """Columns of whole groups out of rows sorted by group, one at a time if ``apart``. One group and one batch are held."""
    held: list[pa.RecordBatch] = []

    def taken() -> list[np.ndarray]:
        whole = pa.Table.from_batches(held)
        held.clear()
        return [np.asarray(whole.column(c)) for c in names]

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        of = np.asarray(batch.column(group))
        cuts = (np.flatnonzero(np.diff(of)) + 1).tolist()
        if held and last != of[0]:
            cuts.insert(0, 0)
        begin = 0
        for end in cuts if apart else cuts[-1:]:
            held.append(batch.slice(begin, end - begin))
            yield taken()
            begin = end
        held.append(batch.slice(begin))
        last = of[-1]
    if held:
        yield taken()


def learn(counts: DataFrame, scratch: Scratch, least: int = LEAST) -> Model:
    """The model from counted n-grams: all that were met ``least`` times, whatever their number.

    Tasks smooth and lay out the n-grams of three symbols and more; the driver sees those of one and two (at most 65,792), what
    the 65,536 pairs leave, and a name for each part of about ``PART_ROWS`` n-grams.
    """
    grams = counts.where(F.col("kind").between(1, ORDER))
    cut = lambda k: F.col("key").bitwiseAND(F.lit((1 << (8 * k)) - 1))
    shorter = F.explode(F.array_compact(F.array(*[F.when(F.col("kind") >= k, F.struct(F.lit(k).alias("k"), cut(k).alias("gram"))) for k in range(1, ORDER + 1)])))
    every = grams.select("n", shorter.alias("g")).groupBy("g.k", "g.gram").agg(F.sum("n").alias("n"))
    every = scratch.keep(every.withColumn("context", F.shiftright("gram", 8)), "grams")
    stays = F.col("n") >= least
    contexts = every.groupBy("k", "context").agg(F.sum("n").alias("whole"), F.count("*").alias("kinds"), F.sum(F.when(stays, F.col("n")).otherwise(0)).alias("kept"))
    whole = F.col("whole") + F.col("kinds")
    kept = every.where(stays).join(contexts.where(F.col("kept") > 0), ["k", "context"])
    kept = scratch.keep(kept.select("k", "gram", (F.col("n") / whole).alias("own"), ((whole - F.col("kept")) / whole).alias("rest")), "kept")

    few = kept.where(F.col("k") <= 2).toArrow()
    low = low_orders(*(np.asarray(few.column(c)) for c in ("k", "gram", "own", "rest")))
    pairs = kept.where(F.col("k") == 3).groupBy(F.shiftright("gram", 8).alias("pair")).agg(F.max("rest").alias("rest")).toArrow()
    name = f"trie-{uuid.uuid4().hex}"
    head = f"{name}.bin"
    with written(f"{scratch.root}/{head}") as out:
        out.write(build_head(low, np.asarray(pairs.column("pair")), np.asarray(pairs.column("rest"))))
    sent = scratch.spark.sparkContext.broadcast(low)

    def smooth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, gram, own, rest in _whole_groups(batches, "ending", ["k", "gram", "own", "rest"], apart=False):
            cost = _stored(smoothed(k, gram, own, rest, sent.value)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(gram), pa.array(cost), pa.array(_stored(rest).astype(np.int32))], names=["k", "gram", "cost", "rest"])

    # an n-gram's endings of three symbols and more share the two symbols before its last
    long = kept.where(F.col("k") >= 3).withColumn("ending", F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF)))
    costs = long.repartition("ending").sortWithinPartitions("ending").mapInArrow(smooth, "k int, gram long, cost int, rest int")
    costs = scratch.keep(costs, "costs")
    of = max(1, math.ceil(costs.count() / PART_ROWS))
    root = scratch.root

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, *rows in _whole_groups(batches, "part", ["part", "k", "gram", "cost", "rest"], apart=True):
            with written(f"{root}/{name}-{part[0]}.bin") as out:
                out.write(build_part(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(part[:1])], names=["part"])

    lead = F.expr("shiftright(gram, 8 * (k - 3))")
    dealt = costs.withColumn("part", part_of(lead, of)).repartition(of, "part").sortWithinPartitions("part", "k", "gram")
    parts = {r["part"]: f"{name}-{r['part']}.bin" for r in dealt.mapInArrow(lay, "part long").collect()}
    return Model(head, parts, of)


def share(model: Model, scratch: Scratch) -> None:
    """Let every executor get the files; they lie in the shared folder and each maps its own copies."""
    for name in (model.head, *model.parts.values()):
        scratch.spark.sparkContext.addFile(f"{scratch.root}/{name}")


_tries: dict[str, Trie] = {}


def trie(model: Model) -> Trie:
    """The mapped trie, once per worker."""
    if model.head not in _tries:
        _tries.clear()
        _tries[model.head] = Trie(SparkFiles.get(model.head), {i: SparkFiles.get(name) for i, name in model.parts.items()}, model.of)
    return _tries[model.head]


_remembered: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _gram_costs(model: Model, keys: np.ndarray) -> np.ndarray:
    """Costs of distinct n-grams; the trie is asked for those this worker has not met lately. Each has one place, which the last to come keeps."""
    if model.head not in _remembered:
        _remembered.clear()
        _remembered[model.head] = np.zeros(1 << REMEMBERED, np.uint64), np.zeros(1 << REMEMBERED)
    known, cost = _remembered[model.head]
    at = (mix(keys) >> np.uint64(64 - REMEMBERED)).astype(np.int64)
    out = cost[at]
    new = np.flatnonzero(known[at] != keys)
    if len(new):
        out[new] = trie(model).gram_costs(keys[new])
        # of several n-grams with one place the same one must leave its key and its cost
        place, last = np.unique(at[new], return_index=True)
        known[place], cost[place] = keys[new[last]], out[new[last]]
    return out


def frequent_words(docs: DataFrame, text_col: str, id_col: str, rows: int = SAMPLE_DOCS, most: int = FREQUENT) -> np.ndarray:
    """Hashes of the ``most`` commonest words of the ``rows`` documents whose id hashes lowest, sorted."""
    chosen = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("o")).distinct().orderBy("o", "id").limit(rows).select("id")
    sample = docs.join(F.broadcast(chosen), docs[id_col] == chosen["id"], "left_semi").select(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        b = _Batch(texts(batch, text_col))
        return pa.RecordBatch.from_arrays([pa.array(b.hashes), pa.array(np.bincount(b.words.codes, minlength=len(b.hashes)))], names=["word", "n"])

    counted = map_arrow(sample, run, "word long, n long", text_col).groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most).toArrow()
    return np.sort(np.asarray(counted.column("word")))


def scores(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``(<id_col>, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row, learnt from the rows not held out.

    Tokens are the words of the text (A-Z folded) and one end. ``base_score`` is the sum of log10((c + 1) / (N + V + 1));
    ``score`` the log10 probability that the model gives the same tokens, spelled out byte by byte. A byte depends on up
    to six symbols before it, of which up to three may belong to the word before (its last two bytes and the space), so
    a batch asks the trie once for each word after each such end. Null texts count
    as empty and have one token. Rows that repeat id and text come out alike and count each in the training; a null id is
    kept. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("h"), held_out(id_col).alias("out"), F.col(text_col).alias("words"))
    training = rows.where(~F.col("out"))
    frequent = frequent_words(training, "words", "id")
    counts = scratch.keep(count(training, frequent, "words"), "counts")
    model = learn(counts, scratch, least)
    share(model, scratch)
    small = counts.where(F.col("kind").isin(_TOKEN, _TOTAL, _TOTAL + 1)).toArrow()
    kind, key, n = (np.asarray(small.column(c)) for c in ("kind", "key", "n"))
    total = int(n[kind == _TOTAL].sum())
    ends = int(n[kind == _TOTAL + 1].sum())
    table = np.zeros(len(frequent), np.int64)
    table[np.searchsorted(frequent, key[kind == _TOKEN])] = n[kind == _TOKEN]
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((frequent, table))

    def others(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        b = _Batch(texts(batch, "words"))
        rare = ~np.isin(b.hashes, sent.value[0])
        on = np.flatnonzero(rare[b.words.codes])
        pair, often = np.unique(b.words.owner()[on] * len(b.hashes) + b.words.codes[on], return_counts=True)
        doc, word = pa.array(pair // max(len(b.hashes), 1)), pair % max(len(b.hashes), 1)
        arrays = [pa.array(b.hashes[word]), column(batch, "h").take(doc), column(batch, "out").take(doc), pa.array(often.astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=["word", "h", "out", "n"])

    # rows of one word meet once: their training count, then one row per document
    each = map_arrow(rows.select("h", "out", "words"), others, "word long, h long, out boolean, n int", "words", SLICE)
    by_word = Window.partitionBy("word")
    each = each.withColumn("c", F.sum(F.when(~F.col("out"), F.col("n")).otherwise(0)).over(by_word))
    each = each.withColumn("first", F.row_number().over(by_word.orderBy("h")) == 1)
    one = each.groupBy("word", "h").agg(F.max("n").alias("n"), F.max("c").alias("c"), F.max("first").alias("first"))
    rare = one.groupBy("h").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_log"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum((F.col("first") & (F.col("c") > 0)).cast("long")).alias("rare_words"),
    )
    rare = scratch.keep(rare, "rare")
    distinct = int((table > 0).sum()) + int(ends > 0) + (rare.agg(F.sum("rare_words")).first()[0] or 0)
    floor = math.log10(total + distinct + 1)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        b = _Batch(texts(batch, "words"))
        known, table = sent.value
        at = np.minimum(np.searchsorted(known, b.hashes), max(len(known) - 1, 0))
        often = known[at] == b.hashes if len(known) else np.zeros(len(b.hashes), bool)
        c = np.where(often, table[at], 0) if len(known) else np.zeros(len(b.hashes), np.int64)
        data, place, begins, of = b.units()
        own = np.zeros(len(data))
        on = _own(begins)
        grams, back = np.unique(_keys(data, place, on), return_inverse=True)
        own[on] = _gram_costs(model, grams)[back]
        spelled = np.add.reduceat(own, begins[:-1])[of] * -math.log10(2)
        texts_at = b.words.starts[:-1] + np.arange(batch.num_rows)
        codes, starts = b.words.codes, b.words.starts

        def sums(values: np.ndarray) -> np.ndarray:
            """Per document, in the order of its own words, so that no row depends on its batch."""
            out = np.zeros(batch.num_rows)
            some = np.flatnonzero(b.words.counts)
            if len(some):
                out[some] = np.add.reduceat(values[codes], starts[:-1][some])
            return out

        arrays = [
            column(batch, "id"), column(batch, "h"), column(batch, "out"), pa.array(b.words.counts + 1), pa.array(sums(np.where(often, np.log10(c + 1.0), 0.0)) + math.log10(ends + 1)),
            pa.array(sums((c > 0).astype(np.float64)).astype(np.int64) + int(ends > 0)), pa.array(np.add.reduceat(spelled, texts_at)),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "h", "out", "n_tokens", "often_log", "often_known", "score"])

    scored = map_arrow(rows, run, f"id {doc_ids_type(docs, id_col)}, h long, out boolean, n_tokens long, often_log double, often_known long, score double", "words", SLICE)
    base = F.col("often_log") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)
    return scored.join(rare, "h", "left").select(
        F.col("id").alias(id_col), F.col("out").alias("held_out"), "n_tokens", (F.col("often_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
