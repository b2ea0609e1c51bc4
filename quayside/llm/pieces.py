"""SentencePiece segmentations sampled from the piece lattice, and their lossless decoding."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quayside.llm.batches import column, doc_ids_type, map_arrow, mix, raw, texts

# Text sampled at a time inside a task.
SLICE = 700_000
# Segments up to this many bytes go through the forward pass together.
TOGETHER = 64
_SLOT_BITS = 19
_SLOT_SHIFT = np.uint64(64 - _SLOT_BITS)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Model:
    """A SentencePiece vocabulary as byte strings (a leading space for U+2581) with a weight for each.

    The model file ranks its pieces and gives no probabilities; a piece of rank r gets the Zipf weight 1 / (r + 10),
    normalised and raised to ``alpha`` (0: all segmentations alike; larger: closer to the single best one). Characters
    without a piece are written as byte pieces, U+2581 itself too, so that decoding gives every text back.
    """

    def __init__(self, path: str, alpha: float) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        special = [i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)]
        self.byte_ids = np.full(256, -1, np.int32)
        strings: list[bytes] = []
        for i in ids:
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(text[3:5], 16)] = i
                strings.append(bytes([int(text[3:5], 16)]))
            else:
                strings.append(b"" if i in special else text.replace("▁", " ").encode())
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary lacks byte pieces, so some texts could not be written")
        normal = [i for i in ids if strings[i] and not sp.is_byte(i)]
        rank = np.argsort(np.argsort([-sp.get_score(i) for i in normal], kind="stable"), kind="stable")
        weight = -np.log(rank + 10.0)
        self.weight = np.full(len(strings), np.inf)
        self.weight[normal] = alpha * (weight - np.log(np.exp(weight).sum()))
        self.weight[self.byte_ids] = alpha * np.log(1e-6)
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.ends = np.cumsum(self.lengths)
        self.bytes = np.frombuffer(b"".join(strings), dtype=np.uint8)
        # bytes that stand in no piece longer than themselves are segments of their own
        inside = set(b"".join(strings[i] for i in normal))
        self.alone = np.array([b not in inside for b in range(256)])
        keys = np.array([_key_of(strings[i]) for i in normal], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(normal, dtype=np.int32)[order]
        # by the first bits of a key: -1 no piece, -2 several, else the one that it may be
        slot = (self.keys >> _SLOT_SHIFT).astype(np.int64)
        self.slots = np.full(1 << _SLOT_BITS, -1, np.int32)
        self.slots[slot] = np.arange(len(slot))
        self.slots[slot[1:][slot[1:] == slot[:-1]]] = -2
        self.sizes = sorted({len(strings[i]) for i in normal})

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece of each key, -1 for none."""
        at = self.slots[(keys >> _SLOT_SHIFT).astype(np.int64)]
        out = np.full(len(keys), -1, np.int32)
        maybe = np.flatnonzero(at >= 0)
        place = at[maybe]
        out[maybe] = np.where(self.keys[place] == keys[maybe], self.key_ids[place], -1)
        rest = np.flatnonzero(at == -2)
        place = np.minimum(np.searchsorted(self.keys, keys[rest]), len(self.keys) - 1)
        out[rest] = np.where(self.keys[place] == keys[rest], self.key_ids[place], -1)
        return out


def _prefix(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running hash of a buffer and the powers that take its differences back to a common start."""
    powers = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(data), _BASE))))
    back = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(data), _UNBASE))))
    spread = mix(np.arange(1, 257, dtype=np.uint64))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread[data] * powers[:-1], dtype=np.uint64))), back


def _key_of(s: bytes) -> np.uint64:
    before, _ = _prefix(np.frombuffer(s, dtype=np.uint8))
    return mix(before[-1:] + np.uint64(len(s)))[0]


@lru_cache(maxsize=2)
def model(path: str, alpha: float) -> Model:
    """One model per worker process."""
    return Model(path, alpha)


class _Lattice:
    """The lattices of distinct segments in one buffer, forward-filtered: for each end, its incoming pieces and their chances.

    An end is a byte position. ``marks`` holds, for the incoming pieces of all ends in order, the end plus the chance that
    the segmentation arrives by this piece or an earlier one; a search for the end plus a random number draws one.
    """

    def __init__(self, m: Model, segments: pa.Array) -> None:
        offsets, data = raw(segments)
        n = len(data)
        lengths = np.diff(offsets)
        segment = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(n) - offsets[:-1][segment]
        room = lengths[segment] - place
        before, back = _prefix(data)
        starts, sizes, ids = [], [], []
        for size in m.sizes:
            at = np.flatnonzero(room >= size)
            if not len(at):
                break
            found = m.find(mix((before[at + size] - before[at]) * back[at] + np.uint64(size)))
            hit = found >= 0
            starts.append(at[hit])
            sizes.append(np.full(int(hit.sum()), size))
            ids.append(found[hit])
        starts.append(unknown := self._unknown(m, data, room, before, back))
        sizes.append(np.ones(len(unknown), np.int64))
        ids.append(m.byte_ids[data[unknown]])
        start, size, piece = (np.concatenate(x) for x in (starts, sizes, ids))
        end = start + size - 1
        order = np.argsort(end, kind="stable")
        start, size, piece, end = start[order], size[order], piece[order], end[order]
        weight = m.weight[piece]
        forward = np.full(n + 1, -np.inf)
        opens = place[start] == 0
        far = place[end]
        short = lengths[segment[end]] <= TOGETHER
        steps = np.argsort(np.where(short, far, -1), kind="stable")
        cuts = np.searchsorted(np.where(short, far, -1)[steps], np.arange(0, TOGETHER + 1))
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                e = steps[a:b]
                value = np.where(opens[e], 0.0, forward[start[e] - 1]) + weight[e]
                first = np.concatenate(([0], np.flatnonzero(np.diff(end[e])) + 1))
                forward[end[e][first]] = np.logaddexp.reduceat(value, first)
        rest = steps[: cuts[0]]  # in order of their ends, segment after segment
        for e, s, w, o in zip(end[rest].tolist(), start[rest].tolist(), weight[rest].tolist(), opens[rest].tolist(), strict=True):
            forward[e] = np.logaddexp(forward[e], (0.0 if o else forward[s - 1]) + w)
        value = np.where(opens, 0.0, forward[start - 1]) + weight
        with np.errstate(invalid="ignore"):
            chance = np.exp(value - forward[end])
        used = chance > 0
        chance, self.size, self.piece, end = chance[used], size[used], piece[used], end[used]
        running = np.cumsum(chance)
        first = np.concatenate(([0], np.flatnonzero(np.diff(end)) + 1)) if len(end) else np.zeros(0, int)
        many = np.diff(np.concatenate((first, [len(end)])))
        within = running - np.repeat(np.concatenate(([0.0], running))[first], many)
        last = np.concatenate((first[1:], [len(end)])) - 1
        within[last] = 1.0
        self.marks = end + np.minimum(within, 1.0)
        self.final = offsets[1:] - 1
        self.lengths = lengths

    @staticmethod
    def _unknown(m: Model, data: np.ndarray, room: np.ndarray, before: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Bytes of characters that have no piece."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        width = np.minimum(np.diff(np.concatenate((lead, [len(data)]))), room[lead])
        none = m.find(mix((before[lead + width] - before[lead]) * back[lead] + width.astype(np.uint64))) < 0
        none |= m.alone[data[lead]] & (width == 1)
        # bytes of a segment that begin inside a character (invalid UTF-8) are unknown too
        flags = np.zeros(len(data), bool)
        mark = np.zeros(len(data) + 1, np.int64)
        np.add.at(mark, lead[none], 1)
        np.add.at(mark, lead[none] + width[none], -1)
        flags |= np.cumsum(mark[:-1]) > 0
        cover = np.zeros(len(data) + 1, np.int64)
        np.add.at(cover, lead, 1)
        np.add.at(cover, lead + width, -1)
        return np.flatnonzero(flags | (np.cumsum(cover[:-1]) == 0))


def sample(array: pa.Array, keys: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ids): a segmentation of each text, drawn with its probability under the piece weights.

    No piece crosses from a word into the space before the next one, so a text's lattice is a chain of segments and
    equal segments of a batch share one forward pass. Each draw is a hash of the text's key, the segment's number and the
    step, so the result depends on nothing but the key, the text and the model. Empty texts have no ids.
    """
    offsets, data = raw(array)
    full = np.flatnonzero(np.diff(offsets))
    counts = np.diff(offsets)[full]
    # a space before each text, as SentencePiece adds it
    begins = np.concatenate(([0], np.cumsum(counts + 1)))
    buffer = np.full(begins[-1], 32, np.uint8)
    own = np.ones(begins[-1], bool)
    own[begins[:-1]] = False
    buffer[own] = data[offsets[0] : offsets[-1]]
    starts = np.zeros(len(offsets), np.int64)
    if not len(buffer):
        return starts, np.zeros(0, np.int32)
    space = buffer == 32
    alone = m.alone[buffer]
    opens = (space & ~np.roll(space, 1)) | alone | np.roll(alone, 1)
    opens[begins[:-1]] = True
    at = np.flatnonzero(opens)
    bounds = np.concatenate((at, [len(buffer)])).astype(np.int64)
    segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(buffer)]).dictionary_encode()
    codes = np.asarray(segments.indices, dtype=np.int64)
    lattice = _Lattice(m, pa.concat_arrays([segments.dictionary]))
    text = np.searchsorted(begins, at, side="right") - 1
    number = np.arange(len(at)) - np.searchsorted(at, begins[:-1])[text]
    seed = mix(keys[full][text] + mix(number.astype(np.uint64)))
    end, left = lattice.final[codes], lattice.lengths[codes]
    on = np.arange(len(at))
    drawn: list[tuple[np.ndarray, np.ndarray]] = []
    step = 0
    while len(on):
        random = (mix(seed[on] + np.uint64(step)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        edge = np.searchsorted(lattice.marks, end[on] + random, side="right")
        drawn.append((on, lattice.piece[edge]))
        size = lattice.size[edge]
        end[on] -= size
        left[on] -= size
        on = on[left[on] > 0]
        step += 1
    many = np.zeros(len(at), np.int64)
    for k, (who, _) in enumerate(drawn):
        many[who] = k + 1
    ends = np.cumsum(many)
    ids = np.empty(ends[-1], np.int32)
    for k, (who, piece) in enumerate(drawn):
        ids[ends[who] - 1 - k] = piece
    starts[full + 1] = np.diff(np.concatenate(([0], ends))[np.concatenate((np.searchsorted(at, begins[:-1]), [len(at)]))])
    return np.cumsum(starts), ids


def decode(starts: np.ndarray, ids: np.ndarray, m: Model) -> pa.Array:
    """The texts of id sequences, any segmentation alike."""
    sizes = m.lengths[ids]
    ends = np.cumsum(sizes)
    spot = np.arange(ends[-1] if len(ends) else 0) + np.repeat(m.ends[ids] - ends, sizes)
    data = m.bytes[spot]
    bounds = np.concatenate(([0], ends))[starts]
    full = np.flatnonzero(np.diff(bounds))
    kept = np.ones(len(data), bool)
    kept[bounds[full]] = False
    lengths = np.diff(bounds)
    lengths[full] -= 1
    out = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(out), pa.py_buffer(np.ascontiguousarray(data[kept])))


def encode_sampled(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", alpha: float = 1.0, seed: int = 0, size: int = SLICE) -> DataFrame:
    """``(<id_col>, n_pieces, ids, lossless)``: a sampled segmentation of every whole text, and whether it decodes to the text.

    The row key is the id as text together with ``seed``; repeated rows come out alike, a null id counts as empty text. A
    null or empty text has no ids. Other columns are ignored. ``model_path`` must be readable on every executor. ``size``
    bytes of text are in work at a time; fewer take less memory and more time, and give the same ids.
    """
    from quayside.llm.batches import hash64

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = model(model_path, alpha)
        array = texts(batch, text_col)
        keys = hash64(column(batch, id_col).cast(pa.large_string()).fill_null(""), seed)
        starts, ids = sample(array, keys, m)
        same = pa.compute.equal(decode(starts, ids, m), array)
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays([column(batch, id_col), pa.array(np.diff(starts)), lists, same], names=[id_col, "n_pieces", "ids", "lossless"])

    schema = f"{id_col} {doc_ids_type(docs, id_col)}, n_pieces long, ids array<int>, lossless boolean"
    return map_arrow(docs.select(id_col, text_col), run, schema, text_col, size)


def decoded(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids", alpha: float = 1.0) -> DataFrame:
    """``(<id_col>, text)`` of encoded rows; null ids give a null text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = pa.concat_arrays([column(batch, ids_col)])
        starts = np.concatenate(([0], np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), dtype=np.int64))))
        out = decode(starts, np.asarray(lists.flatten(), dtype=np.int64), model(model_path, alpha)).cast(pa.string())
        return pa.RecordBatch.from_arrays([column(batch, id_col), pa.compute.if_else(lists.is_null(), pa.scalar(None, pa.string()), out)], names=[id_col, "text"])

    return map_arrow(encoded.select(id_col, ids_col), run, f"{id_col} {doc_ids_type(encoded, id_col)}, text string")
