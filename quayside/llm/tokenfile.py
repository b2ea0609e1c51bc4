"""Token ids of documents in files of patched frame-of-reference blocks."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.batches import column, raw, slices, texts
from quayside.llm.files import opened, written
from quayside.llm.ranges import BUCKET, dealt, wanted_buckets, with_bucket
from quayside.plans.session import Scratch

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

BLOCK = 256
# Share of a block's values that the packed width must hold; the others are exceptions.
PERCENTILE = 0.9
# Blocks packed or unpacked at a time.
CHUNK_BLOCKS = 2048
MAGIC = b"PFOR0001"
_HEAD = struct.Struct("<IBHH")  # minimum, width, values, exceptions
_FOOT = struct.Struct("<QQQQ8s")  # ids, blocks, documents, where the index starts, magic
SLICE = 3_000_000
# Pre-tokens strung together for one call of the tokenizer.
STRUNG = 200

# Byte classes of the tokenizer's own splitting rule, for texts that need no other: white space, letters (those of U+00C0 to
# U+027F too), digits, the rest.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[b for b in range(128) if chr(b).isalpha()]] = _LETTER
_CLASS[[b for b in range(128) if chr(b).isdigit()]] = _DIGIT
_CLASS[128:] = _LETTER


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """One tokenizer per worker process, as the library reads it: the string of a special token in a text gives its id."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _special(path: str) -> tuple[str, ...]:
    """The strings of a tokenizer's special tokens."""
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


def _without_special(array: pa.Array, path: str) -> np.ndarray:
    """Texts that hold the string of no special token."""
    out = np.ones(len(array), bool)
    for text in _special(path):
        out &= ~np.asarray(pc.match_substring(array, text))
    return out


def _plain(array: pa.Array) -> np.ndarray:
    """Texts whose splitting the byte classes tell: no apostrophe, no character from U+0080 to U+00BF or past U+027F, no sign of multiplication or division."""
    offsets, data = raw(array)
    odd = (data == 39) | (data >= 0xCA) | (data == 0xC2)
    after_c3 = np.zeros(len(data), bool)
    after_c3[1:] = data[:-1] == 0xC3
    odd |= after_c3 & ((data == 0x97) | (data == 0xB7))
    before = np.concatenate(([0], np.cumsum(odd)))
    return before[offsets[1:]] == before[offsets[:-1]]


def _pieces(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pre-tokens one after the other, how many each text has) of plain texts."""
    offsets, data = raw(array)
    kind = _CLASS[data]
    space = kind == _SPACE
    opens_text = np.zeros(len(data) + 1, bool)
    opens_text[offsets[:-1]] = True
    opens_text = opens_text[: len(data)]
    before = np.zeros(len(data), bool)
    before[1:] = space[:-1]
    before &= ~opens_text
    joins = np.zeros(len(data), bool)
    joins[1:] = data[:-1] == 32
    change = np.zeros(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    ends = np.zeros(len(data), bool)  # white space right before something else of the same text
    ends[:-1] = ~space[1:] & ~opens_text[1:]
    opens = opens_text | (~space & ~before & change) | (~space & before & ~joins) | (space & ~before) | (space & before & ends)
    at = np.flatnonzero(opens)
    bounds = np.concatenate((at, [len(data)])).astype(np.int64)
    counts = np.diff(np.searchsorted(at, offsets))
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds), array.buffers()[2]), counts


@lru_cache(maxsize=2)
def _opens_with_space(path: str) -> np.ndarray:
    """Whether each id's token starts with a space (written as U+0120 in the vocabulary)."""
    found = tokenizer(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(found.values()) + 1, bool)
    out[[i for t, i in found.items() if t.startswith("\u0120")]] = True
    return out


def _distinct(strings: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of each pre-token, all ids in order). A space with letters goes to the tokenizer strung together with others.

    In such a string only a pre-token's first id starts with a space, which tells where each begins.
    """
    coder = tokenizer(path)
    cells = strings.to_pylist()
    offsets, data = raw(pa.concat_arrays([strings]))
    letters = np.concatenate(([0], np.cumsum(_CLASS[data] == _LETTER)))
    length = np.diff(offsets)
    strung = (length > 1) & (letters[offsets[1:]] - letters[offsets[:-1]] == length - 1)
    strung[strung] = data[offsets[:-1][strung]] == 32
    sizes = np.zeros(len(cells), np.int64)
    rows = np.flatnonzero(strung)
    lines = ["".join(cells[r] for r in rows[k : k + STRUNG].tolist()) for k in range(0, len(rows), STRUNG)]
    found = [np.array(e.ids, dtype=np.uint32) for e in coder.encode_batch_fast(lines, add_special_tokens=False)]
    first = np.concatenate(found) if found else np.zeros(0, np.uint32)
    begins = np.flatnonzero(_opens_with_space(path)[first])
    if len(begins) != len(rows):
        raise ValueError("this tokenizer does not keep a leading space to the first id of a word")
    sizes[rows] = np.diff(np.append(begins, len(first)))
    rest = np.flatnonzero(~strung)
    own = [e.ids for e in coder.encode_batch_fast([cells[r] for r in rest.tolist()], add_special_tokens=False)]
    sizes[rest] = [len(ids) for ids in own]
    flat = np.empty(sizes.sum(), np.uint32)
    of = np.repeat(strung, sizes)
    flat[of] = first
    flat[~of] = np.fromiter((i for ids in own for i in ids), dtype=np.uint32, count=int(sizes[rest].sum()))
    return sizes, flat


def encode(array: pa.Array, path: str, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ids) of texts, each followed by ``end_id``.

    The tokenizer encodes a text pre-token by pre-token, so for plain texts it is asked once per distinct pre-token of the
    batch. All others go to it whole.
    """
    coder = tokenizer(path)
    plain = (_plain(array) & _without_special(array, path))
    counts = np.zeros(len(array), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []  # (texts, ids) in order
    easy = np.flatnonzero(plain)
    if len(easy):
        tokens, many = _pieces(pa.concat_arrays([array.filter(pa.array(plain))]))
        coded = tokens.dictionary_encode()
        of = np.asarray(coded.indices, dtype=np.int64)
        sizes, flat = _distinct(coded.dictionary, path)
        begins = np.cumsum(sizes) - sizes
        n = sizes[of]
        ends = np.cumsum(n)
        ids = flat[np.repeat(begins[of] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        counts[easy] = np.diff(np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(many)))])
        parts.append((easy, ids))
    hard = np.flatnonzero(~plain)
    if len(hard):
        known = [e.ids for e in coder.encode_batch_fast(array.take(pa.array(hard)).to_pylist(), add_special_tokens=False)]
        counts[hard] = [len(ids) for ids in known]
        parts.append((hard, np.fromiter((i for ids in known for i in ids), dtype=np.uint32, count=int(counts[hard].sum()))))
    extra = 0 if end_id is None else 1
    starts = np.concatenate(([0], np.cumsum(counts + extra)))
    out = np.full(starts[-1], end_id or 0, np.uint32)
    for who, ids in parts:
        n = counts[who]
        out[np.repeat(starts[who] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
    return starts, out


def pack(values: np.ndarray) -> list[bytes]:
    """Blocks of ``BLOCK`` values each (the last may be shorter), packed."""
    n = len(values)
    if not n:
        return []
    sizes = np.full(-(-n // BLOCK), BLOCK)
    sizes[-1] = n - BLOCK * (len(sizes) - 1)
    grid = np.concatenate((values, np.full(BLOCK * len(sizes) - n, values[n - sizes[-1] :].min(), np.uint32))).reshape(-1, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    held = np.partition(rest, int(BLOCK * PERCENTILE) - 1, axis=1)[:, int(BLOCK * PERCENTILE) - 1]
    widths = np.ceil(np.log2(held.astype(np.float64) + 1)).astype(np.int64)
    out: list[bytes] = [b""] * len(sizes)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        mine = rest[rows]
        bits = np.unpackbits(mine.astype("<u4").view(np.uint8).reshape(len(rows), BLOCK, 4), axis=2, bitorder="little", count=width) if width else None
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little") if width else np.zeros((len(rows), 0), np.uint8)
        high = mine >> np.uint32(width) if width < 32 else np.zeros_like(mine)
        line, place = np.nonzero(high)
        cuts = np.searchsorted(line, np.arange(len(rows) + 1))
        places, highs = place.astype("<u2"), high[line, place].astype("<u4")
        for k, r in enumerate(rows.tolist()):
            a, b = cuts[k], cuts[k + 1]
            out[r] = _HEAD.pack(int(low[r]), width, int(sizes[r]), b - a) + packed[k].tobytes() + places[a:b].tobytes() + highs[a:b].tobytes()
    return out


def unpack(blocks: list[bytes]) -> np.ndarray:
    """The values of consecutive blocks."""
    heads = [_HEAD.unpack_from(b) for b in blocks]
    grid = np.zeros((len(blocks), BLOCK), np.uint32)
    widths = np.array([h[1] for h in heads])
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        if width:
            size = BLOCK * width // 8
            packed = np.frombuffer(b"".join(blocks[r][_HEAD.size : _HEAD.size + size] for r in rows.tolist()), dtype=np.uint8).reshape(len(rows), size)
            bits = np.zeros((len(rows), BLOCK, 32), np.uint8)
            bits[:, :, :width] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, width)
            grid[rows] = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little").view("<u4")
    for r, (_, width, _, n) in enumerate(heads):
        if n:
            at = _HEAD.size + BLOCK * width // 8
            place = np.frombuffer(blocks[r], dtype="<u2", count=n, offset=at)
            grid[r, place] |= np.frombuffer(blocks[r], dtype="<u4", count=n, offset=at + 2 * n) << np.uint32(width)
    grid += np.array([h[0] for h in heads], dtype=np.uint32)[:, None]
    flat = grid.ravel()
    return flat[: len(flat) - BLOCK + heads[-1][2]] if heads else flat


class Writer:
    """Ids as they come, in a file of blocks, followed by where each block and each document starts."""

    def __init__(self, out) -> None:
        self.out, self.at, self.total = out, len(MAGIC), 0
        self.held: list[np.ndarray] = []
        self.waiting = 0
        self.starts: list[int] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        out.write(MAGIC)

    def add(self, doc_ids: np.ndarray, has_id: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((doc_ids, has_id, counts))
        self.total += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        size = BLOCK * CHUNK_BLOCKS
        if self.waiting >= size:
            flat = np.concatenate(self.held)
            whole = len(flat) // BLOCK * BLOCK
            for a in range(0, whole, size):
                self._store(flat[a : min(a + size, whole)])
            self.held, self.waiting = [flat[whole:]], len(flat) - whole

    def _store(self, ids: np.ndarray) -> None:
        blocks = pack(ids)
        ends = np.cumsum([len(b) for b in blocks]) if blocks else []
        self.starts += [self.at, *(self.at + ends[:-1]).tolist()] if blocks else []
        self.at += int(ends[-1]) if blocks else 0
        self.out.write(b"".join(blocks))

    def close(self) -> None:
        self._store(np.concatenate(self.held) if self.held else np.zeros(0, np.uint32))
        docs = [np.concatenate(c) if self.docs else np.zeros(0) for c in (zip(*self.docs, strict=True) if self.docs else ((), (), ()))]
        for values, kind in zip([np.array(self.starts), *docs], ("<u8", "<i8", "u1", "<u4"), strict=True):
            self.out.write(values.astype(kind).tobytes())
        self.out.write(_FOOT.pack(self.total, len(self.starts), len(docs[0]), self.at, MAGIC))


class Reader:
    """A token file: any range of ids by the block index, or all documents in order."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - _FOOT.size)
        self.total, blocks, docs, self.index, magic = _FOOT.unpack(source.read(_FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        source.seek(self.index)
        self.starts = np.append(np.frombuffer(source.read(8 * blocks), dtype="<u8").astype(np.int64), self.index)
        self.doc_ids = np.frombuffer(source.read(8 * docs), dtype="<i8")
        self.has_id = np.frombuffer(source.read(docs), dtype="u1").astype(bool)
        self.counts = np.frombuffer(source.read(4 * docs), dtype="<u4").astype(np.int64)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a to b - 1; only the blocks that hold them are read."""
        a, b = max(a, 0), min(b, self.total)
        if a >= b:
            return np.zeros(0, np.uint32)
        first, last = a // BLOCK, (b - 1) // BLOCK + 1
        self.source.seek(int(self.starts[first]))
        data = self.source.read(int(self.starts[last] - self.starts[first]))
        cuts = (self.starts[first : last + 1] - self.starts[first]).tolist()
        values = unpack([data[x:y] for x, y in zip(cuts, cuts[1:], strict=False)])
        return values[a - first * BLOCK : b - first * BLOCK]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first document, documents, their ids) in parts of about a chunk of blocks; a longer document is a part of its own."""
        ends = np.cumsum(self.counts)
        part = (ends - 1) // (BLOCK * CHUNK_BLOCKS) if len(ends) else ends
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(ends)])) if len(ends) else []
        for x, y in zip(cuts, cuts[1:], strict=False):
            begin = int(ends[x - 1]) if x else 0
            yield int(x), int(y - x), self.ids(begin, int(ends[y - 1]))


def write(docs: DataFrame, folder: str, scratch: Scratch, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 2) -> DataFrame:
    """Token files of all documents under ``folder``, in ascending id order over and inside files: ``(bucket, path, documents, n_ids)``.

    Null texts count as empty, so a document has at least ``end_id``. Rows without an id come first, rows that repeat one
    side by side, in the order of their texts. Other columns are ignored. Texts are shuffled once, by ranges of the id.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("words"))
    buckets = wanted_buckets(rows, "doc_id")
    ranged = dealt(with_bucket(rows, "doc_id", buckets), buckets).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("words").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (part for batch in batches if batch.num_rows for part in slices(batch, "words", SLICE))
        first = next(batches, None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        name = f"{folder}/ids-{number:08d}.pfor"
        n = 0
        with written(name) as out:
            writer = Writer(out)
            while first is not None:
                starts, ids = encode(texts(first, "words"), path, end_id)
                own = column(first, "doc_id")
                writer.add(np.asarray(pc.fill_null(own, 0)), np.asarray(own.is_valid()), np.diff(starts), ids)
                n += first.num_rows
                first = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([name]), pa.array([n], pa.int64()), pa.array([writer.total], pa.int64())], names=["bucket", "path", "documents", "n_ids"])

    return scratch.keep(ranged.select("doc_id", "words").mapInArrow(run, "bucket long, path string, documents long, n_ids long"), "token-files")


def read(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files that ``write`` listed.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is over the ids as little-endian 32-bit integers.
    """
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over one row per file
    placed = files.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(column(batch, "path").to_pylist(), column(batch, "start").to_pylist(), strict=True):
                fs, inner = opened(name)
                with fs.open_input_file(inner) as source:
                    reader = Reader(source)
                    for first, n, ids in reader.documents():
                        counts = reader.counts[first : first + n]
                        ends = np.cumsum(counts)
                        data = memoryview(ids.astype("<u4").tobytes())
                        sums = [zlib.crc32(data[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                        own = pa.array(reader.doc_ids[first : first + n], mask=~reader.has_id[first : first + n])
                        yield pa.RecordBatch.from_arrays([own, pa.array(start + ends - counts), pa.array(counts), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(counts.sum())

    n = max(files.count(), 1)
    return placed.repartition(min(n, 10_000), "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
