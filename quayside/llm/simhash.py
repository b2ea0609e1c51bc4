"""SimHash near-duplicates through an index of fingerprint bytes by position."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import Words, column, doc_ids_type, map_arrow, texts, xxh64_slices
from quayside.llm.components import connected
from quayside.plans.session import Scratch, hinted

BYTES = 8


def batch_fingerprints(array: pa.Array, width: int = 3, seed: int = 42) -> np.ndarray:
    """SimHash per text: a bit is 1 if set in over half the XXH64 of its ``width``-word shingles, repeats included."""
    words = Words(pc.ascii_lower(array))
    n = len(array)
    lengths = np.asarray(pc.binary_length(words.values), dtype=np.int64)
    # all words one after the other, a space after each: a shingle is one slice
    ends = np.cumsum(lengths + 1)
    begins = ends - lengths - 1
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), words.values), pa.scalar(" ", pa.large_string()))[0].as_buffer().to_pybytes()
    runs = np.where(words.counts >= width, words.counts - width + 1, np.minimum(words.counts, 1))
    run_starts = np.concatenate(([0], np.cumsum(runs)))
    owner = np.repeat(np.arange(n), runs)
    first = words.starts[:-1][owner] + np.arange(run_starts[-1]) - run_starts[:-1][owner]
    last = first + np.minimum(words.counts, width)[owner] - 1
    hashes = xxh64_slices(joined, begins[first], ends[last] - 1 - begins[first], seed)
    out = np.zeros(n, np.uint64)
    some = np.flatnonzero(runs)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, run_starts[:-1][some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > runs[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return out

_KEY = "__near_key"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``(id, fp)``, one row per row of ``docs``; a null text counts as empty and has fingerprint 0."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch_fingerprints(texts(batch, text_col), width, seed).view(np.int64)
        return pa.RecordBatch.from_arrays([column(batch, id_col), pa.array(fps)], names=["id", "fp"])

    return map_arrow(docs.select(id_col, text_col), run, f"id {doc_ids_type(docs, id_col)}, fp long", text_col)


def _linked(group: np.ndarray, fps: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of the fingerprints that link inside runs of equal ``group``; both arrays in group order.

    Small runs are compared position by position. In large ones each fingerprint looks up those that differ from it in
    up to ``most_bits`` of the bits outside the shared bytes, so the work follows the run's size, not its square.
    """
    cut = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)]))
    sizes = np.diff(cut)
    left, right = [], []
    of_run = np.repeat(sizes, sizes)
    at = np.arange(len(group)) - np.repeat(cut[:-1], sizes)
    small = np.flatnonzero((of_run > 1) & (of_run <= 64))
    step = 1
    while len(small := small[at[small] + step < of_run[small]]):
        near = np.bitwise_count(fps[small] ^ fps[small + step]) <= most_bits
        left.append(small[near])
        right.append(small[near] + step)
        step += 1
    for r in np.flatnonzero(sizes > 64):
        mine = fps[cut[r] : cut[r + 1]]
        order = np.argsort(mine)
        ranked = mine[order]
        free = np.bitwise_or.reduce(mine ^ mine[0])
        bits = [b for b in range(64) if int(free) >> b & 1]
        for k in range(1, most_bits + 1):
            for chosen in combinations(bits, k):
                mask = np.uint64(sum(1 << b for b in chosen))
                found = np.minimum(np.searchsorted(ranked, mine ^ mask), len(mine) - 1)
                hit = np.flatnonzero(ranked[found] == mine ^ mask)
                left.append(cut[r] + hit)
                right.append(cut[r] + order[found[hit]])
    if not left:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(group))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for ends in (a, b, label[a], label[b]):
            np.minimum.at(new, ends, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = np.flatnonzero(label != np.arange(len(group)))
    return fps[label[rest]], fps[rest]


def links(distinct: DataFrame, most_bits: int = 2) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints of column ``fp`` (distinct) within ``most_bits`` of each other.

    Two fingerprints that differ in ``most_bits`` bits share at least ``8 - most_bits`` of their 8 positional bytes. The
    index has a list per set of that many positions and their bytes, so a pair meets there exactly when its tally of
    shared positional bytes reaches the guaranteed minimum; pairs that meet are verified bit by bit. A list of single
    positions would hold 1/256 of all rows; these hold at most 2^(8 * most_bits) distinct fingerprints. Inside a list,
    edges are reduced to stars, so copies of one text by the thousand give thousands of rows, not millions.
    """
    masks = [sum(0xFF << (8 * p) for p in kept) for kept in combinations(range(BYTES), BYTES - most_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posting = F.explode(F.array(*[F.struct(F.lit(i).cast("short").alias("positions"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("shared")) for i, m in enumerate(signed)]))
    postings = distinct.select("fp", posting.alias("p")).select("p.positions", "p.shared", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            held.append(tuple(np.asarray(batch.column(i)) for i in range(3)))
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            change = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0))
            if not len(change):
                held = [tuple(cols)]
                continue
            cut = change[-1] + 1
            held = [tuple(c[cut:] for c in cols)]
            yield from found([c[:cut] for c in cols])
        if held:
            yield from found([np.concatenate(c) for c in zip(*held, strict=True)])

    def found(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        new = np.concatenate(([0], np.cumsum((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)))) if len(cols[0]) else np.zeros(0, int)
        a, b = _linked(new, cols[2].view(np.uint64), most_bits)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    dealt = postings.repartition("positions", "shared").sortWithinPartitions("positions", "shared")
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most_bits: int = 2, seed: int = 42
) -> DataFrame:
    """``(<id_col>, fingerprint, component_id)`` for every row of ``docs``.

    Documents whose fingerprints differ in at most ``most_bits`` bits are linked; ``component_id`` is the smallest id
    reachable over links. Null and empty texts have fingerprint 0 and link like any other. A row without an id gets the
    smallest id of its component, null when none has one. Repeated rows come out repeated. Other columns are ignored.
    An empty table gives no rows.
    """
    prints = scratch.keep(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    classes = scratch.keep(prints.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = connected(links(classes.select("fp"), most_bits), scratch)
    member = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    member = scratch.keep(member, "members")
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = member.join(least, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group left: that with the smallest id, null ids last.

    Rows go by id and text, so an unlike text under a repeated id is a document of its own. Rows that repeat both are one
    document, and of those the one with the smallest hash over all columns stays.
    """
    key = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"))
    found = near_duplicates(docs.select(key.alias(_KEY), F.col(f"`{text_col}`").alias("text")), scratch, _KEY, "text", width, most_bits)
    drop = scratch.keep(found.where(F.col(_KEY) != F.col("component_id")).select(_KEY).distinct(), "drop")
    kept = docs.join(hinted(drop, drop.count()), key == F.col(_KEY), "left_anti")
    twice = scratch.keep(docs.groupBy(key.alias(_KEY)).count().where("count > 1").select(_KEY), "twice")
    n = twice.count()
    if not n:
        return kept
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    repeated = kept.join(hinted(twice, n), key == F.col(_KEY), "left_semi").groupBy(key).agg(first.alias("__row")).select("__row.*")
    return kept.join(hinted(twice, n), key == F.col(_KEY), "left_anti").unionByName(repeated)
