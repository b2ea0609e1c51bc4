"""Periodic runs of words: every maximal stretch that repeats a shorter piece, and texts with the repeats taken out.

A run of period p and at least ``EXPONENT`` periods covers three neighbouring points of the grid 0, p, 2p ... that hold the
same word as the point after them, so looking at the grids of all periods (a harmonic sum of points) misses none. Where a
grid matches, two longest-common-extension queries, ahead and back, give the run's bounds. Extensions come from a difference
cover: only suffixes that start at positions whose remainder modulo ``MODULUS`` is in ``COVER`` are sorted. Any two positions
become two of those after the same few steps, which are compared word by word; from there the answer is the least common
prefix between the two suffixes' ranks, read from a sparse table.

A task takes texts in slices of bounded size and looks at all texts of a slice at once. Its memory grows with the slice or
the one text that is longer. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import Words, column, map_arrow, texts

EXPONENT = 4
SHORTEST = 6
# Every remainder modulo 13 is the difference of two members of the cover.
MODULUS = 13
COVER = (0, 1, 3, 9)
# Grid points looked at together.
POINTS = 1 << 20


def _steps() -> np.ndarray:
    """For two remainders the least number of steps after which both are in the cover."""
    inside = [r in COVER for r in range(MODULUS)]
    out = np.empty((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            out[a, b] = next(d for d in range(MODULUS) if inside[(a + d) % MODULUS] and inside[(b + d) % MODULUS])
    return out


_STEPS = _steps()
_IN_COVER = np.isin(np.arange(MODULUS), COVER)


class Extensions:
    """Longest common extensions ahead, between positions of the same text.

    ``codes`` are the words of several texts (0 or more), ``starts[i]:starts[i+1]`` those of text i.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray) -> None:
        self.codes = codes.astype(np.int64)
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        self.end = starts[1:][owner]
        self.local = np.arange(len(codes)) - starts[:-1][owner]
        self.sample = np.flatnonzero(_IN_COVER[self.local % MODULUS])
        # number of each sampled position among the samples; those behind a text's end have none
        self.number = np.full(len(codes), -1, np.int64)
        self.number[self.sample] = np.arange(len(self.sample))
        self._sort(owner[self.sample])
        self._measure()
        self._table()

    def _word(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The word at each position plus 1, and 0 behind the end of its text."""
        safe = np.minimum(at, len(self.codes) - 1)
        return np.where(at < end, self.codes[safe] + 1, 0)

    def _sort(self, owner: np.ndarray) -> None:
        """Ranks of the samples by text and then by words; ``snapshots[k]`` are equal where MODULUS * 2**k words are."""
        n = len(self.sample)
        end = self.end[self.sample]
        width = max(int(self.codes.max(initial=0)) + 2, 2).bit_length()
        per = max(1, 62 // width)
        keys = []
        for first in range(0, MODULUS, per):
            key = np.zeros(n, np.int64)
            for j in range(first, min(first + per, MODULUS)):
                key = (key << width) | self._word(self.sample + j, end)
            keys.append(key)
        order = np.lexsort([*reversed(keys), owner])
        same = owner[order][1:] == owner[order][:-1]
        for key in keys:
            same &= key[order][1:] == key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = self._heads(same)
        self.snapshots = [rank.copy()]
        length = MODULUS
        while same.any():
            # positions in groups of equals are ordered by the rank of what follows; the others stay
            tied = np.zeros(n, bool)
            tied[1:] |= same
            tied[:-1] |= same
            where = np.flatnonzero(tied)
            some = order[where]
            behind = self.sample[some] + length
            following = np.where(behind < end[some], rank[self.number[np.minimum(behind, len(self.codes) - 1)]], -1)
            again = np.lexsort([following, rank[some]])
            some, following = some[again], following[again]
            order[where] = some
            equal = np.zeros(n, bool)
            equal[where[1:]] = (rank[some][1:] == rank[some][:-1]) & (following[1:] == following[:-1])
            same = equal[1:] if n else equal
            fresh = rank.copy()
            fresh[order] = self._heads(same)
            rank = fresh
            self.snapshots.append(rank)
            length *= 2
        self.order, self.rank = order, rank

    @staticmethod
    def _heads(same: np.ndarray) -> np.ndarray:
        """For each place of a sorted list the first place of its group of equals."""
        n = len(same) + 1
        places = np.arange(n)
        places[1:][same] = 0
        return np.maximum.accumulate(places)

    def _measure(self) -> None:
        """Common prefix, in words, of each sample with the one before it in the order."""
        n = len(self.sample)
        if n < 2:
            self.common = np.zeros(n, np.int64)
            return
        a, b = self.sample[self.order[:-1]], self.sample[self.order[1:]]
        end_a, end_b = self.end[a], self.end[b]
        met = np.zeros(n - 1, np.int64)
        last = len(self.codes) - 1
        for k in range(len(self.snapshots) - 1, -1, -1):
            rank = self.snapshots[k]
            at_a, at_b = a + met, b + met
            live = np.flatnonzero((at_a < end_a) & (at_b < end_b) & (end_a == end_b))
            x, y = self.number[np.minimum(at_a[live], last)], self.number[np.minimum(at_b[live], last)]
            met[live[rank[x] == rank[y]]] += MODULUS << k
        live = np.flatnonzero(end_a == end_b)
        for _ in range(MODULUS):
            at_a, at_b = a[live] + met[live], b[live] + met[live]
            word = self._word(at_a, end_a[live])
            live = live[(word == self._word(at_b, end_b[live])) & (word > 0)]
            met[live] += 1
        self.common = np.concatenate(([0], met))
        del self.snapshots

    def _table(self) -> None:
        """Minima of ``common`` over stretches of every power of two."""
        rows = [self.common.astype(np.int32)]
        while len(rows[-1]) > 1 << (len(rows) - 1):
            half = 1 << (len(rows) - 1)
            rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
        self.table = rows

    def _between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Least common prefix between two different ranks."""
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        out = np.empty(len(x), np.int64)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            on = np.flatnonzero(level == k)
            row = self.table[k]
            out[on] = np.minimum(row[low[on]], row[high[on] - (1 << k)])
        return out

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from the positions ``i`` and ``j`` on (``i < j``, both in one text)."""
        end = self.end[i]
        steps = _STEPS[self.local[i] % MODULUS, self.local[j] % MODULUS]
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for _ in range(MODULUS):
            live = live[out[live] < steps[live]]
            if not len(live):
                break
            word = self._word(j[live] + out[live], end[live])
            live = live[(word == self._word(i[live] + out[live], end[live])) & (word > 0)]
            out[live] += 1
        on = np.flatnonzero((out == steps) & (j + steps < end))
        x, y = self.number[i[on] + steps[on]], self.number[j[on] + steps[on]]
        out[on] += self._between(self.rank[x], self.rank[y])
        return out


def find(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run, by text, start and period; starts count inside the text."""
    counts = np.diff(starts)
    found = [np.zeros((0, 3), np.int64)]
    periods = counts // EXPONENT
    # the grids of all periods of all texts, cut into parts of bounded size
    text = np.repeat(np.arange(len(counts)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = np.maximum(0, -(-(counts[text] - (EXPONENT - 1) * period) // period))
    part = np.cumsum(points) // POINTS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(text)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        p, size = period[a:b], points[a:b]
        place = np.repeat(starts[text[a:b]] - (np.cumsum(size) - size) * p, size)
        step = np.repeat(p, size)
        place += np.arange(len(step)) * step
        for j in range(EXPONENT - 1):
            same = codes[place + j * step] == codes[place + (j + 1) * step]
            place, step = place[same], step[same]
        if len(place):
            found.append(np.stack([place, step, np.searchsorted(starts, place, side="right") - 1], 1))
    hits = np.concatenate(found)
    if not len(hits):
        return (np.zeros(0, np.int64),) * 4
    # extensions are needed in the texts that have hits, both ways: the reversed texts answer the way back
    some = np.unique(hits[:, 2])
    n = counts[some]
    own = np.concatenate(([0], np.cumsum(n)))
    source = np.repeat(starts[some] - own[:-1], n) + np.arange(own[-1])
    back = np.repeat(starts[some] + n - 1 + own[:-1], n) - np.arange(own[-1])
    forward, backward = Extensions(codes[source], own), Extensions(codes[back], own)
    runs = []
    for first in range(0, len(hits), POINTS):
        place, p, t = hits[first : first + POINTS].T
        which = np.searchsorted(some, t)
        i = place - starts[t] + own[which]
        after = forward.ahead(i, i + p)
        before = np.zeros(len(i), np.int64)
        # the position before i is, in the reversed text, as far from its end
        inner = np.flatnonzero(i > own[which])
        mirror = own[which[inner]] + own[which[inner] + 1] - i[inner]
        before[inner] = backward.ahead(mirror - p[inner], mirror)
        length = after + before + p
        good = (length >= EXPONENT * p) & (length >= SHORTEST)
        runs.append(np.unique(np.stack([t, place - starts[t] - before, length, p], 1)[good], axis=0))
    runs = np.unique(np.concatenate(runs), axis=0)
    # of a stretch's periods the smallest counts; it comes first
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :3] != runs[:-1, :3]).any(1)
    runs = runs[first]
    order = np.lexsort([runs[:, 3], runs[:, 1], runs[:, 0]])
    return tuple(runs[order].T)


def _repeated(starts: np.ndarray, h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """For every word the number of the word that takes its place: texts with ``h % 10 == 0`` end in a repeated piece."""
    counts = np.diff(starts)
    place = np.arange(starts[-1])
    for t in np.flatnonzero(known & (h % 10 == 0) & (counts > 0)).tolist():
        g, n = int(h[t]) // 10, int(counts[t])
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        place[starts[t] + a : starts[t + 1]] = starts[t] + a + np.arange(n - a) % p
    return place


FIELDS = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", repeat: bool = False, with_text: bool = False) -> DataFrame:
    """One row per document: its runs' number and digest, its longest run, and the digest of its text without repeats.

    A run is a stretch of words with smallest period q, at least ``EXPONENT`` times q and ``SHORTEST`` words long, that no
    neighbouring word extends. Words that lie in a run after its first q words are dropped. A null or wordless text has no
    runs. Repeated rows and ids keep a row each. With ``repeat`` texts chosen by the checksum of their id are altered first
    to end in a repeated piece; documents without an id stay as they are. ``with_text`` adds the text that is left
    (``collapsed``: words by single spaces) and ``runs``, a line ``start,length,period`` each.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(texts(batch, "text"))
        starts, codes = words.starts, words.codes.astype(np.int64)
        taken = np.arange(len(codes))
        if repeat:
            h = column(batch, "h")
            taken = _repeated(starts, np.asarray(pc.fill_null(h, 0), dtype=np.int64), np.asarray(h.is_valid()))
        codes = codes[taken]
        t, start, length, period = find(codes, starts)
        n = len(words.counts)
        number = np.bincount(t, minlength=n).astype(np.int64)
        first = np.searchsorted(t, np.arange(n + 1))
        # covered words: +1 where a run's repeats begin, -1 behind its end
        marks = np.zeros(len(codes) + 1, np.int64)
        np.add.at(marks, starts[t] + start + period, 1)
        np.add.at(marks, starts[t] + start + length, -1)
        left = np.cumsum(marks)[:-1] == 0
        best = np.zeros(n, np.int64)
        order = np.lexsort([period, start, -length, t])
        has = number > 0
        best[has] = order[first[:-1][has]]
        listed = ["".join(f"{a},{b},{c}\n" for a, b, c in zip(start[x:y].tolist(), length[x:y].tolist(), period[x:y].tolist(), strict=True)) for x, y in zip(first, first[1:], strict=False)]
        kept = np.concatenate(([0], np.cumsum(np.bincount(words.owner()[left], minlength=n))))
        values = words.vocabulary.take(pa.array(codes[left]))
        collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), values), pa.scalar(" ", values.type))

        def chosen(values: np.ndarray) -> pa.Array:
            return pa.array(values[best] if len(values) else np.zeros(n, np.int64), pa.int64(), mask=~has)

        out = [
            column(batch, "key"), pa.array(number), chosen(start), chosen(length), chosen(period), chosen(1000 * length // np.maximum(period, 1)),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]),
            pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in collapsed.cast(pa.large_binary())]),
        ]
        names = ["key", *[f.split()[0] for f in FIELDS.split(", ")]]
        if with_text:
            out, names = [*out, collapsed.cast(pa.string()), pa.array(listed, pa.string())], [*names, "collapsed", "runs"]
        return pa.RecordBatch.from_arrays(out, names=names)

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.crc32(F.col(f"`{key}`").cast("string")).alias("h"))
    more = ", collapsed string, runs string" if with_text else ""
    return map_arrow(rows, one, f"key {rows.schema['key'].dataType.simpleString()}, {FIELDS}{more}", "text").withColumnRenamed("key", key)
