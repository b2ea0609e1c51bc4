"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, and what differs between two of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import Words, column, doc_ids_type, hash64, map_arrow, mix, slices, texts
from quayside.llm.lines import split_lines
from quayside.llm.ranges import BUCKET, dealt, wanted_buckets, with_bucket

# Cells of a published fingerprint, and by how much a sketch grows when it cannot be peeled.
CELLS = 12
GROWTH = 4
HASHES = 3
# A line is cut after a word whose hash is a multiple of this, so one long line is several paragraphs too.
CUT = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Digests:
    """64-bit digests of the paragraphs of texts: ``keys[starts[i]:starts[i + 1]]`` are text i's, all different.

    A paragraph is a line, or a part of one that ends where the words themselves say so; its digest is that of its words
    in order. The k-th repetition in a text has a digest of its own. A text without words has none.
    """

    def __init__(self, array: pa.Array) -> None:
        lines, counts = split_lines(array)
        words = Words(lines)
        doc_of_line = np.repeat(np.arange(len(counts)), counts)
        if not len(words.codes):
            self.keys, self.starts = np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
            return
        hashes = hash64(words.vocabulary, 7)[words.codes]
        line = words.owner()
        opens = np.ones(len(hashes), bool)
        opens[1:] = (line[1:] != line[:-1]) | (hashes[:-1] % np.uint64(CUT) == 0)
        first = np.flatnonzero(opens)
        place = np.arange(len(hashes)) - np.repeat(first, np.diff(np.append(first, len(hashes))))
        keys = mix(np.add.reduceat(mix(hashes + place.astype(np.uint64) * _STEP), first))
        doc = doc_of_line[line[first]]
        order = np.lexsort((keys, doc))
        again = np.zeros(len(keys), np.int64)
        same = np.zeros(len(keys), bool)
        same[1:] = (keys[order][1:] == keys[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        run = np.arange(len(keys))
        again[order] = run - np.maximum.accumulate(np.where(same, 0, run))
        self.keys = np.where(again > 0, mix(keys + again.astype(np.uint64) * _STEP), keys)
        self.starts = np.searchsorted(doc, np.arange(len(counts) + 1))

    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys of these texts one after the other, which of ``rows`` each belongs to)."""
        n = self.counts()[rows]
        owner = np.repeat(np.arange(len(rows)), n)
        return self.keys[np.repeat(self.starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())], owner


def _places(keys: np.ndarray, owner: np.ndarray, cells: int) -> np.ndarray:
    """The cells of each key, one in each third of its sketch."""
    third = cells // HASHES
    salts = [np.uint64(((j + 1) * int(_STEP) + cells) % (1 << 64)) for j in range(HASHES)]
    return np.stack([owner * cells + j * third + (mix(keys + salt) % np.uint64(third)).astype(np.int64) for j, salt in enumerate(salts)])


def _check(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)


class Sketch:
    """Sketches of many texts with the same number of cells: a count, the exclusive or of the keys and that of their checks."""

    def __init__(self, keys: np.ndarray, owner: np.ndarray, n: int, cells: int) -> None:
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, np.int64)
        self.key, self.check = (np.zeros(n * cells, np.uint64) for _ in range(2))
        self.put(keys, owner, np.ones(len(keys), np.int64))

    def put(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray) -> None:
        for place in _places(keys, owner, self.cells):
            np.add.at(self.count, place, sign)
            np.bitwise_xor.at(self.key, place, keys)
            np.bitwise_xor.at(self.check, place, _check(keys))

    def minus(self, other: Sketch) -> Sketch:
        out = Sketch(np.zeros(0, np.uint64), np.zeros(0, np.int64), self.n, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, key, sign) of what is left in the sketches, and which were emptied; uses the sketches up."""
        found: list[tuple[np.ndarray, ...]] = []
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            pure = look[(np.abs(self.count[look]) == 1) & (_check(self.key[look]) == self.check[look])]
            if not len(pure):
                break
            owner, key, sign = pure // self.cells, self.key[pure], self.count[pure]
            order = np.lexsort((key, owner))
            new = np.ones(len(order), bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            pick = order[new]
            owner, key, sign = owner[pick], key[pick], sign[pick]
            found.append((owner, key, sign))
            self.put(key, owner, -sign)
            look = np.unique(_places(key, owner, self.cells))
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        emptied = ~left.reshape(self.n, self.cells).any(axis=1) if self.n else np.zeros(0, bool)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), emptied
        return *(np.concatenate(c) for c in zip(*found, strict=True)), emptied

    def strings(self) -> list[str]:
        """Each sketch in hexadecimal: of each cell the count's low byte, the keys and the checks."""
        cell = np.zeros((self.n * self.cells, 13), np.uint8)
        cell[:, 0] = (self.count & 0xFF).astype(np.uint8)
        cell[:, 1:9] = self.key.astype(">u8").view(np.uint8).reshape(-1, 8)
        cell[:, 9:13] = self.check.astype(">u4").view(np.uint8).reshape(-1, 4)
        whole = cell.tobytes().hex()
        size = 26 * self.cells
        return [whole[i * size : (i + 1) * size] for i in range(self.n)]


def differences(a: Digests, rows_a: np.ndarray, b: Digests, rows_b: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, sign) of the paragraphs that only the first (+1) or only the second (-1) text of each pair has.

    Sketches of ``cells`` cells are subtracted and peeled; the pairs that do not peel are tried again with more cells.
    """
    pairs = np.arange(len(rows_a))
    out: list[tuple[np.ndarray, ...]] = []
    while len(pairs):
        rest = Sketch(*a.of(rows_a[pairs]), len(pairs), cells).minus(Sketch(*b.of(rows_b[pairs]), len(pairs), cells))
        owner, key, sign, emptied = rest.peel()
        done = emptied[owner]
        out.append((pairs[owner[done]], key[done], sign[done]))
        pairs = pairs[~emptied]
        cells *= GROWTH
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))


def likeness(a: Digests, rows_a: np.ndarray, b: Digests, rows_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the paragraphs of each pair, by what peeling recovers; two texts without words are alike."""
    pair, _, _ = differences(a, rows_a, b, rows_b)
    d = np.bincount(pair, minlength=len(rows_a))
    total = a.counts()[rows_a] + b.counts()[rows_b]
    return np.where(total + d > 0, (total - d) / np.maximum(total + d, 1), 1.0)


def changes(versions: DataFrame, id_col: str = "doc_id", old_col: str = "old", new_col: str = "new") -> DataFrame:
    """``(<id_col>, removed, added, likeness)``: the paragraph digests that only one version of each row has. Null texts count as empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (Digests(texts(batch, c)) for c in (old_col, new_col))
        rows = np.arange(batch.num_rows)
        pair, key, sign = differences(a, rows, b, rows)
        lists = []
        for side in (1, -1):
            mine = np.flatnonzero(sign == side)
            mine = mine[np.lexsort((key[mine], pair[mine]))]
            lists.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(pair[mine], np.arange(len(rows) + 1)).astype(np.int32)), pa.array(key[mine].view(np.int64))))
        return pa.RecordBatch.from_arrays([column(batch, id_col), *lists, pa.array(likeness(a, rows, b, rows))], names=[id_col, "removed", "added", "likeness"])

    schema = f"{id_col} {doc_ids_type(versions, id_col)}, removed array<long>, added array<long>, likeness double"
    return map_arrow(versions.select(id_col, old_col, new_col), run, schema, old_col)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, fingerprint)`` of every row; equal texts have equal fingerprints, null ones that of the empty text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        d = Digests(texts(batch, text_col))
        prints = Sketch(*d.of(np.arange(batch.num_rows)), batch.num_rows, CELLS).strings()
        return pa.RecordBatch.from_arrays([column(batch, id_col), pa.array(prints, pa.string())], names=[id_col, "fingerprint"])

    return map_arrow(docs.select(id_col, text_col), run, f"{id_col} {doc_ids_type(docs, id_col)}, fingerprint string", text_col)


def edited(text: str, other: str) -> str:
    """``text`` with its last third of code points replaced by as many from the start of ``other`` (or all it has)."""
    third = len(text) // 3
    return text[: len(text) - third] + other[:third]


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint against that of its edited text and of the next document.

    ``(<id_col>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``. The next document is
    the one that follows in descending id order, after the last the first; rows without an id come last, rows that repeat
    one in the order of their texts; a table of one row is its own next. Null texts count as empty. Other columns are
    ignored. Texts are shuffled once, by ranges of the id; each range also gets the one document that follows it.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("words"))
    buckets = wanted_buckets(rows, "id")
    placed = with_bucket(rows, "id", buckets).withColumn("follows", F.lit(False))
    heads = sorted((r[0], r[1]) for r in placed.groupBy(BUCKET).agg(F.max("id").alias("head")).collect())
    if heads:
        # the document after a range's last is the head of the next lower range
        spark = docs.sparkSession
        kind = doc_ids_type(docs, id_col)
        extra = spark.createDataFrame([(heads[k - 1][1], b) for k, (b, _) in enumerate(heads)], f"head {kind}, target int")
        again = placed.join(F.broadcast(extra), placed["id"].eqNullSafe(extra["head"]))
        placed = placed.unionByName(again.select("id", "words", F.col("target").alias(BUCKET), F.lit(True).alias("follows")))
    ordered = dealt(placed, buckets).sortWithinPartitions(BUCKET, "follows", F.col("id").desc_nulls_last(), F.col("words").asc()).select("id", "words", "follows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        ended = False
        for batch in batches:
            for part in slices(batch, "words"):
                if ended:
                    continue
                if held is not None:
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                follows = np.asarray(column(part, "follows").cast(pa.uint8()))
                if follows.any():  # only the first of the rows that follow counts
                    part, ended = part.slice(0, int(follows.argmax()) + 1), True
                held = part.slice(part.num_rows - 1)
                if part.num_rows > 1:
                    yield compared(part)

    def compared(part: pa.RecordBatch) -> pa.RecordBatch:
        own = column(part, "words").to_pylist()
        n = len(own) - 1
        new = [edited(own[i], own[i + 1]) for i in range(n)]
        a, b = Digests(texts(part, "words")), Digests(pa.array(new, pa.large_string()))
        rows = np.arange(n)
        prints = [Sketch(*d.of(rows), n, CELLS).strings() for d in (a, b)]
        arrays = [
            column(part, "id").slice(0, n), pa.array([len(t) for t in own[:n]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
            *(pa.array(p, pa.string()) for p in prints), pa.array(likeness(a, rows, b, rows)), pa.array(likeness(a, rows, a, rows + 1)),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = f"{id_col} {doc_ids_type(docs, id_col)}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(run, schema)
