"""Near-duplicate lines by an exact set-similarity join, and their removal after the first."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import Words, column, hash64, map_arrow, mix, raw, release, shingle_hashes, slices, texts
from quayside.plans.session import BROADCAST_ROWS, Scratch, hinted

WIDTH = 5
THRESHOLD = 0.8
# Cells of the frequency table that puts tokens in order. Its size is fixed; any order gives the same result.
CELLS = 1 << 18
_CELL_SHIFT = np.uint64(64 - 18)
_BLOCK = 1 << 14
# Line sets a task remembers to have dealt out; it starts anew beyond, which costs repeated postings and changes no result.
REMEMBERED = 500_000
# Postings that a task sorts and deals at a time; about how many a group of tokens has, and how many groups there are at least.
PACKED = 1 << 19
GROUP = 1 << 18
LEAST_GROUPS = 1024
_HASH = np.uint64((1 << 56) - 1)
_KEY_CELL = np.uint64(56 - 18)
# Line numbers that may be broadcast in all.
BROADCAST_LINES = 2_000_000


def split_lines(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(lines, lines per text): texts cut after every line feed; an empty text is one empty line."""
    offsets, data = raw(array)
    feeds = np.flatnonzero(data == 10) + 1
    starts = np.concatenate((feeds, offsets[:-1]))
    starts = np.sort(starts, kind="stable")
    counts = 1 + np.diff(np.searchsorted(feeds, offsets, side="right"))
    bounds = np.concatenate((starts, offsets[-1:])).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), array.buffers()[2]), counts


def _shingles(lines: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    words = Words(pc.ascii_lower(lines))
    hashes = hash64(words.vocabulary, 42)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    return shingle_hashes(hashes, words.starts, width)


class LineSets:
    """The token sets of lines: ``tokens[starts[i]:starts[i + 1]]`` are line i's distinct shingles, rarest first.

    A token is its rarity class (from the frequency table) over 56 bits of the shingle's hash, so its value is its place
    in the order.
    """

    def __init__(self, lines: pa.Array, rarity: np.ndarray, width: int) -> None:
        hashes, starts = _shingles(lines, width)
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        tokens = (rarity[(hashes >> _CELL_SHIFT).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))
        if len(starts) <= 1 << 16:  # sorting short integers stably is quick
            order = np.argsort(tokens)
            order = order[np.argsort(owner[order].astype(np.uint16), kind="stable")]
        else:
            order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order], owner[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        self.tokens = tokens[new]
        self.sizes = np.bincount(owner[new], minlength=len(starts) - 1)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        # equal sets have equal sums: two 64-bit halves of their class
        some = np.flatnonzero(self.sizes)
        self.low, self.high = (np.zeros(len(self.sizes), np.uint64) for _ in range(2))
        if len(some):
            spread = mix(self.tokens)
            self.low[some] = np.add.reduceat(spread, self.starts[some])
            self.high[some] = np.add.reduceat(mix(spread), self.starts[some])


def token_frequencies(docs: DataFrame, text_col: str = "text", width: int = WIDTH) -> np.ndarray:
    """Rarity classes of the cells of a fixed-size table that counts the shingles of all lines of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, text_col):
                hashes, _ = _shingles(split_lines(texts(part, text_col))[0], width)
                counts += np.bincount((hashes >> _CELL_SHIFT).astype(np.int64), minlength=CELLS)
        if counts.any():
            blocks = [c.astype("<u4").tobytes() for c in np.minimum(counts, 2**32 - 1).reshape(-1, _BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(column(batch, "block").to_pylist(), column(batch, "counts").to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(cells, dtype="<u4").astype(np.float64)
        for block, cells in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([cells.tobytes()], pa.binary())], names=["block", "counts"])

    blocks = docs.select(text_col).mapInArrow(run, "block int, counts binary").repartition("block").mapInArrow(add, "block int, counts binary").collect()
    total = np.zeros((CELLS // _BLOCK, _BLOCK))
    for row in blocks:
        total[row["block"]] = np.frombuffer(row["counts"])
    return np.minimum(4 * np.log2(1 + total.ravel()), 255).astype(np.uint8)


def prefix_length(n: np.ndarray, threshold: float) -> np.ndarray:
    """Tokens of a set of n that must hold one shared with any set similar enough."""
    return n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1


def _compatible(size: np.ndarray, place: np.ndarray, with_size: int, with_place: int, threshold: float) -> np.ndarray:
    """Length filter, and positional filter for a pair whose first shared token stands at these places."""
    need = np.ceil(threshold / (1 + threshold) * (size + with_size) - 1e-9)
    reach = 1 + np.minimum(size - place, with_size - with_place) - 1
    return (np.minimum(size, with_size) >= threshold * np.maximum(size, with_size) - 1e-9) & (reach >= need)


def _later_matches(tokens: np.ndarray, starts: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    """Which sets of a run, in line order, are similar to an earlier one. Each set meets only those still without a match.

    Of a set of ``size`` tokens those from the run's own token on are given.
    """
    given = np.diff(starts)
    place = size - given
    _, ids = np.unique(tokens, return_inverse=True)
    flag = np.zeros(len(tokens) + 1, bool)
    matched = np.zeros(len(size), bool)
    rest = np.arange(1, len(size))
    for i in range(len(size) - 1):
        rest = rest[np.searchsorted(rest, i, side="right") :]
        near = rest[_compatible(size[rest], place[rest], size[i], place[i], threshold)]
        if not len(near):
            continue
        own = ids[starts[i] : starts[i + 1]]
        flag[own] = True
        many = given[near]
        bounds = np.concatenate(([0], np.cumsum(many)))
        at = np.repeat(starts[near] - bounds[:-1], many) + np.arange(bounds[-1])
        shared = np.add.reduceat(flag[ids[at]], bounds[:-1], dtype=np.int64)
        flag[own] = False
        hit = near[shared >= threshold * (size[near] + size[i] - shared) - 1e-9]
        matched[hit] = True
        rest = rest[~matched[rest]]
    return matched


def _runs(held: list, batch: pa.RecordBatch) -> tuple[pa.Table | None, list]:
    """(whole runs of equal ``token``, what may go on in the next batch), for batches sorted by token."""
    table = pa.Table.from_batches([*held, batch])
    token = np.asarray(table.column("token"))
    change = np.flatnonzero(np.diff(token))
    if not len(change):
        return None, [*held, batch]
    cut = int(change[-1]) + 1
    return table.slice(0, cut), table.slice(cut).combine_chunks().to_batches()


def _packed(key: np.ndarray, low: np.ndarray) -> bytes:
    """Postings as bytes: the 56 bits of the tokens byte by byte (of ascending ones the upper bytes compress well), then the classes."""
    return key.view(np.uint8).reshape(-1, 8)[:, :7].T.tobytes() + low.tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 15
    key = np.zeros((n, 8), np.uint8)
    key[:, :7] = np.frombuffer(data, np.uint8, 7 * n).reshape(7, n).T
    return key.view("<u8").ravel(), np.frombuffer(data, "<u8", n, 7 * n)


def shared_runs(lines: DataFrame, rarity: Broadcast, scratch: Scratch) -> DataFrame:
    """``(token, low)``: of the postings ``(low, prefix)`` those of tokens that several classes share, one token for each set of classes.

    Postings are dealt by ranges of the token's hash, many to a row.
    """
    many = lines.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    groups = max(LEAST_GROUPS, -(-many // GROUP))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            prefix = column(batch, "prefix")
            low = np.repeat(np.asarray(column(batch, "low")).view(np.uint64), np.asarray(pc.list_value_length(prefix)))
            held.append((np.asarray(prefix.flatten()).view(np.uint64) & _HASH, low))
            if sum(len(k) for k, _ in held) >= PACKED:
                yield by_group(held)
                held = []
        if held:
            yield by_group(held)
        release()

    def by_group(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, low = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(key)
        key, low = key[order], low[order]
        group = ((key >> np.uint64(24)) * np.uint64(groups)) >> np.uint64(32)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(key)])).tolist()
        rows = [_packed(key[a:b], low[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.RecordBatch.from_arrays([pa.array(group[cuts[:-1]].astype(np.int32)), pa.array(rows, pa.binary())], names=["group", "postings"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        last = None
        for batch in batches:
            for group, data in zip(column(batch, "group").to_pylist(), column(batch, "postings").to_pylist(), strict=True):
                if held and group != last:
                    yield repeated(held)
                    held = []
                held.append(data)
                last = group
        if held:
            yield repeated(held)
        release()

    def repeated(held: list[bytes]) -> pa.RecordBatch:
        key, low = (np.concatenate(c) for c in zip(*map(_unpacked, held), strict=True))
        order = np.argsort(key)
        on = order[_met_again(key[order])]
        on = on[np.lexsort((low[on], key[on]))]
        key, low = key[on], low[on]
        new = np.ones(len(key), bool)  # the first of each class in a run
        new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1])
        key, low = key[new], low[new]
        on = _met_again(key)
        key, low = key[on], low[on]
        token = (rarity.value[(key >> _KEY_CELL).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | key
        # runs with the same classes have the same name
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        name = np.repeat(mix(np.add.reduceat(mix(low), first)), np.diff(np.append(first, len(key)))) if len(key) else low
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in (token, low, name)], names=["token", "low", "name"])

    dealt = lines.where(F.size("prefix") > 0).select("low", "prefix").mapInArrow(pack, "group int, postings binary").repartition("group").sortWithinPartitions("group")
    runs = scratch.keep(dealt.mapInArrow(shared, "token long, low long, name long"), "runs")
    # copies share many tokens: of runs with the same classes the one of the first token in order is enough, as it is the
    # first that any two of them share
    once = runs.groupBy("name").agg(F.min(_unsigned(F.col("token"))).alias("least"))
    return scratch.keep(runs.join(once, "name").where(_unsigned(F.col("token")) == F.col("least")).select("token", "low"), "first-runs")


def _met_again(key: np.ndarray) -> np.ndarray:
    """Which of ascending keys stand there more than once."""
    out = np.zeros(len(key), bool)
    out[1:] = key[1:] == key[:-1]
    out[:-1] |= out[1:].copy()
    return out


def removed_lines(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, h, line)``: the lines, numbered from 0, that have an earlier line with the same or a similar token set.

    A line's tokens are its distinct ``width``-word shingles (A-Z folded; a shorter line is one token); a line without
    words has none and stays. Lines are similar at a Jaccard similarity of ``threshold`` or more. Earlier is by id, then by the hash ``h`` of
    the text, then by line. Rows without an id take no part; rows with the same id and text are one document.

    1. a fixed-size frequency table gives the order of rarity;
    2. lines with equal sets are one class, pre-aggregated, so a line that stands everywhere is one row;
    3. two similar sets share one of their first ``n - ceil(threshold * n) + 1`` tokens: classes, here named by half their
       128 bits, are dealt by these, and only tokens that several classes share go on, one for each set of classes;
    4. in a run of classes with such a token, length and positional filters and the exact Jaccard similarity decide; all that
       two sets share stands from the first token they share on, so a run gets a set's tokens from its own on.
    """
    keyed = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("words"))
    sent = docs.sparkSession.sparkContext.broadcast(token_frequencies(keyed, "words", width))

    def each_line(batch: pa.RecordBatch, seen: list[np.ndarray]) -> pa.RecordBatch:
        lines, counts = split_lines(texts(batch, "words"))
        sets = LineSets(lines, sent.value, width)
        doc = np.repeat(np.arange(len(counts)), counts)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        some = np.flatnonzero(sets.sizes)
        # the prefix of a class once per task
        low, new = np.unique(sets.low[some], return_index=True)
        fresh = ~np.isin(low, seen[0], assume_unique=True)
        new = new[fresh]
        seen[0] = np.union1d(seen[0], low[fresh]) if len(seen[0]) + len(new) <= REMEMBERED else low
        first = np.zeros(len(some), np.int64)
        first[new] = prefix_length(sets.sizes[some[new]], threshold)
        at = np.repeat(sets.starts[some] - (np.cumsum(first) - first), first) + np.arange(first.sum())
        prefix = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(first))).astype(np.int32)), pa.array(sets.tokens[at].view(np.int64)))
        take = pa.array(doc[some])
        arrays = [
            column(batch, "id").take(take), column(batch, "h").take(take), pa.array(number[some].astype(np.int32)), pa.array(sets.low[some].view(np.int64)),
            pa.array(sets.high[some].view(np.int64)), prefix,
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "h", "line", "low", "high", "prefix"])

    def per_task() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        seen = [np.zeros(0, np.uint64)]
        return lambda batch: each_line(batch, seen)

    lines = scratch.keep(map_arrow(keyed, per_task, "id long, h long, line int, low long, high long, prefix array<long>", "words", per_task=True), "lines")
    place = F.struct("id", "h", "line")
    classes = scratch.keep(lines.groupBy("low", "high").agg(F.min(place).alias("first"), F.count("*").alias("copies")), "classes")
    runs = shared_runs(lines, sent, scratch)
    wanted = runs.join(classes, "low").groupBy("first.id", "first.h").agg(F.collect_list(F.struct("first.line", "token")).alias("runs"))
    wanted = scratch.keep(wanted.select("id", "h", F.col("runs.line").alias("numbers"), F.col("runs.token").alias("run")), "wanted")
    texts_again = keyed.join(few(wanted, "numbers"), ["id", "h"])

    def sets_again(batch: pa.RecordBatch, seen: list[np.ndarray]) -> pa.RecordBatch | None:
        # rows with the same id and text once per task; the others of a run are left out where it is checked
        name, new = np.unique(mix(np.asarray(column(batch, "id")).view(np.uint64)) ^ np.asarray(column(batch, "h")).view(np.uint64), return_index=True)
        fresh = ~np.isin(name, seen[0], assume_unique=True)
        seen[0] = np.union1d(seen[0], name[fresh]) if len(seen[0]) + len(name) <= REMEMBERED else name
        if not fresh.any():
            return None
        batch = batch.take(pa.array(np.sort(new[fresh])))
        lines, counts = split_lines(texts(batch, "words"))
        begin = np.cumsum(counts) - counts
        numbers, of_run = column(batch, "numbers"), column(batch, "run")
        many = np.asarray(pc.list_value_length(numbers), dtype=np.int64)
        doc = np.repeat(np.arange(len(counts)), many)
        line, which = np.unique(begin[doc] + np.asarray(numbers.flatten(), dtype=np.int64), return_inverse=True)
        sets = LineSets(pa.concat_arrays([lines.take(pa.array(line))]), sent.value, width)
        # a line's tokens from that of the run on, which it has once, for each of its runs
        run = np.asarray(of_run.flatten()).view(np.uint64)
        size, start = sets.sizes[which], sets.starts[:-1][which]
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        on = sets.tokens[at] >= np.repeat(run, size)
        given = np.add.reduceat(on, np.cumsum(size) - size, dtype=np.int64) if len(size) else size
        tokens = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(given))).astype(np.int32)), pa.array(sets.tokens[at[on]].view(np.int64)))
        arrays = [
            pa.array(run.view(np.int64)), column(batch, "id").take(pa.array(doc)), column(batch, "h").take(pa.array(doc)), pa.array((line[which] - begin[doc]).astype(np.int32)),
            pa.array(sets.low[which].view(np.int64)), pa.array(sets.high[which].view(np.int64)), pa.array(size.astype(np.int32)), tokens,
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["token", "id", "h", "line", "low", "high", "size", "tokens"])

    def again_per_task() -> Callable[[pa.RecordBatch], pa.RecordBatch | None]:
        seen = [np.zeros(0, np.uint64)]
        return lambda batch: sets_again(batch, seen)

    meeting = map_arrow(texts_again, again_per_task, "token long, id long, h long, line int, low long, high long, size int, tokens array<long>", "words", per_task=True)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            whole, held = _runs(held, batch)
            if whole is not None:
                yield from later(whole)
        if held:
            yield from later(pa.Table.from_batches(held))

    def later(table: pa.Table) -> Iterator[pa.RecordBatch]:
        place = [np.asarray(table.column(c)) for c in ("token", "id", "h", "line")]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in place], axis=0)
        table = (table if new.all() else table.filter(pa.array(new))).combine_chunks()
        token, size = np.asarray(table.column("token")), np.asarray(table.column("size"), dtype=np.int64)
        cut = np.concatenate(([0], np.flatnonzero(np.diff(token)) + 1, [len(token)]))
        lists = pa.concat_arrays(table.column("tokens").chunks)
        starts = np.asarray(lists.offsets, dtype=np.int64)
        tokens = np.asarray(lists.values)
        out = np.zeros(len(token), bool)
        for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False):
            out[a:b] = _later_matches(tokens[starts[a] : starts[b]], starts[a : b + 1] - starts[a], size[a:b], threshold)
        yield from table.select(["low", "high"]).filter(pa.array(out)).to_batches()

    dealt = meeting.repartition("token").sortWithinPartitions("token", "id", "h", "line")
    matched = scratch.keep(dealt.mapInArrow(verified, "low long, high long").distinct(), "matched")
    gone = classes.join(matched.withColumn("similar", F.lit(True)), ["low", "high"], "left").where("copies > 1 or similar")
    hit = lines.select("id", "h", "line", "low", "high").join(gone, ["low", "high"])
    return hit.where(F.col("similar") | (place != F.col("first"))).select("id", "h", "line").distinct()


def _unsigned(token: Column) -> Column:
    """Tokens as longs that sort as the unsigned numbers they are."""
    return token.bitwiseXOR(F.lit(-(1 << 63)))


def few(grouped: DataFrame, lists: str) -> DataFrame:
    """A written table of lists, with a broadcast hint when its rows and its list entries are few."""
    rows, entries = grouped.agg(F.count("*"), F.coalesce(F.sum(F.size(lists)), F.lit(0))).first()
    return hinted(grouped, rows if entries <= BROADCAST_LINES else BROADCAST_ROWS + 1)


def without_repeats(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: float = THRESHOLD, counts: tuple[str, str] = ("n_lines", "n_removed")
) -> DataFrame:
    """``docs`` with the lines of ``removed_lines`` taken out of the text, and ``n_lines`` and ``n_removed`` added (under the names ``counts``, replaced if there).

    Null texts stay null and have no lines. A text that loses all its lines is empty. Other columns pass through.
    """
    gone = removed_lines(docs, scratch, id_col, text_col, width, threshold)
    gone = scratch.keep(gone.groupBy("id", "h").agg(F.collect_list("line").alias("numbers")), "gone")
    at = few(gone, "numbers").select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("numbers").alias("__numbers"))
    joined = docs.join(at, (docs[id_col].cast("long") == F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__h")), "left")
    cut = F.split(text_col, "\n")
    kept = F.array_join(F.filter(cut, lambda _, i: ~F.array_contains("__numbers", i)), "\n")
    new = {
        text_col: F.when(F.col("__numbers").isNull(), F.col(text_col)).otherwise(kept),
        counts[0]: F.when(F.col(text_col).isNotNull(), F.size(cut)).otherwise(0).cast("long"),
        counts[1]: F.when(F.col("__numbers").isNull(), 0).otherwise(F.size("__numbers")).cast("long"),
    }
    names = [*docs.columns, *(c for c in counts if c not in docs.columns)]
    return joined.withColumns(new).select(*names)
