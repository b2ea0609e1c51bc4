"""Arrow batches in and out of Spark tasks, and whole-batch word splitting."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

# Text handled at a time inside a task, so that a task's memory does not depend on its partition.
SLICE_BYTES = 1_000_000


def map_arrow(df: DataFrame, fn: Callable, schema: str, text: str | None = None, size: int = SLICE_BYTES, per_task: bool = False) -> DataFrame:
    """``df.mapInArrow`` with a function of one batch; batches are cut to about ``size`` bytes of column ``text``.

    With ``per_task``, ``fn()`` gives each task a function of its own, which may keep state between batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = fn() if per_task else fn
        for batch in batches:
            for part in slices(batch, text, size) if text else (batch,):
                out = one(part)
                if out is not None and out.num_rows:
                    yield out
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back to the system: workers outlive their tasks and sit beside others on an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each with about ``size`` bytes of text; a longer text is a part of its own."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    part = np.cumsum(sizes) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with null read as empty, starting at offset 0 of its own buffers."""
    filled = pc.fill_null(column(batch, name), "")
    return pa.concat_arrays([filled.cast(pa.large_string())])


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a large_string array that starts at offset 0."""
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def mapped(array: pa.Array, table: np.ndarray) -> pa.Array:
    """Every byte replaced through a table of 256 (which must map ASCII to ASCII and leave the rest)."""
    offsets, data = raw(array)
    return pa.LargeStringArray.from_buffers(len(array), pa.py_buffer(offsets), pa.py_buffer(table[data]))


class Words:
    """The words of a batch of texts: ``starts[i]:starts[i+1]`` are text i's in ``codes``, which index ``vocabulary``."""

    def __init__(self, array: pa.Array) -> None:
        lists = pc.ascii_split_whitespace(array)
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        full = np.asarray(pc.binary_length(values), dtype=np.int64) > 0
        if not full.all():
            before = np.concatenate(([0], np.cumsum(full)))
            values, offsets = values.filter(pa.array(full)), before[offsets]
        self.values = values
        self.starts = offsets
        self.counts = np.diff(offsets)
        encoded = values.dictionary_encode()
        self.codes = np.asarray(encoded.indices, dtype=np.int32)
        self.vocabulary = encoded.dictionary

    def owner(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def hash64(strings: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH64 of each string's UTF-8 bytes."""
    offsets, data = raw(pa.concat_arrays([strings.cast(pa.large_binary())]))
    return xxh64_slices(data.tobytes(), offsets[:-1], np.diff(offsets), seed)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over all output bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SHINGLE = np.uint64(0x9E3779B97F4A7C15)


def shingle_seed(width: int) -> np.uint64:
    """What the hash of a run of ``width`` words starts from, so that runs of unlike widths never meet."""
    return mix(np.array([width], np.uint64) + _SHINGLE)[0]


def shingle_step(so_far: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a run with one word more; ``mix`` it in the end."""
    return (so_far ^ word) * _SHINGLE + (word >> np.uint64(32))


def shingle_hashes(hashes: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words per text, a shorter text being one run; and where each text's runs start.

    A text without words has none.
    """
    counts = np.diff(starts)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    run_starts = np.concatenate(([0], np.cumsum(runs)))
    first = np.repeat(starts[:-1] - run_starts[:-1], runs) + np.arange(run_starts[-1])
    out = np.full(len(hashes), shingle_seed(width))
    for j in range(min(width, len(hashes))):
        out[: len(out) - j] = shingle_step(out[: len(out) - j], hashes[j:])
    out = mix(out)[first]
    for size in range(1, width):
        at = starts[:-1][counts == size]
        if len(at):
            short = np.full(len(at), shingle_seed(size))
            for j in range(size):
                short = shingle_step(short, hashes[at + j])
            out[run_starts[:-1][counts == size]] = mix(short)
    return out, run_starts


def doc_ids_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


# The five primes of the public XXH64 specification.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _lane(acc: np.ndarray, value: np.ndarray) -> np.ndarray:
    return _turn(acc + value * _P2, 31) * _P1


def xxh64_slices(data: bytes, begins: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of many slices of one buffer at once; slices of 256 bytes or more go one by one."""
    padded = np.frombuffer(data + bytes(8), dtype=np.uint8)
    eights = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    out = np.empty(len(begins), np.uint64)
    great = np.flatnonzero(lengths >= 256)
    for i in great.tolist():
        out[i] = xxhash.xxh64_intdigest(data[begins[i] : begins[i] + lengths[i]], seed)
    rest = np.flatnonzero(lengths < 256)
    at, size, s = begins[rest], lengths[rest], np.uint64(seed)
    with np.errstate(over="ignore"):
        h = np.full(len(rest), s + _P5)
        stripes = size // 32
        long = np.flatnonzero(stripes)
        if len(long):
            acc = [np.full(len(long), x) for x in (s + _P1 + _P2, s + _P2, s, s - _P1)]
            for k in range(int(stripes[long].max())):
                on = np.flatnonzero(stripes[long] > k)
                for j in range(4):
                    acc[j][on] = _lane(acc[j][on], eights[at[long[on]] + 32 * k + 8 * j])
            total = sum((_turn(a, r) for a, r in zip(acc, (1, 7, 12, 18), strict=True)), np.zeros(len(long), np.uint64))
            for a in acc:
                total = (total ^ _lane(np.uint64(0), a)) * _P1 + _P4
            h[long] = total
        h = h + size.astype(np.uint64)
        at = at + 32 * stripes
        left = size - 32 * stripes
        for k in range(3):
            on = np.flatnonzero(left >= 8 * (k + 1))
            h[on] = _turn(h[on] ^ _lane(np.uint64(0), eights[at[on] + 8 * k]), 27) * _P1 + _P4
        at, left = at + left // 8 * 8, left % 8
        on = np.flatnonzero(left >= 4)
        h[on] = _turn(h[on] ^ ((eights[at[on]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        at, left = at + left // 4 * 4, left % 4
        for k in range(3):
            on = np.flatnonzero(left > k)
            h[on] = _turn(h[on] ^ (padded[at[on] + k].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        out[rest] = h ^ (h >> np.uint64(32))
    return out
