"""The whole load path: align, convert, cut, drop duplicates, write, record."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.convert import ERRORS, UNREADABLE, conform
from quayside.operators import ledger as L
from quayside.operators.align import AlignmentError, default_column, insertable
from quayside.operators.batches import MAX_ROWS, batch_token, base_token, cut_batches, token_error
from quayside.operators.index import with_row_index
from quayside.operators.log import INLINE_ROWS, Log, Snapshot
from quayside.operators.route import UNITS, is_bad
from quayside.plans.session import BROADCAST_ROWS, Scratch, hinted
from quayside.plans.storage import Storage
from quayside.types import ColumnSpec, storage_type

COMMIT, LOAD, TOKEN = "_commit", "_load", "_token"
# Calls with such an id put their files directly into the table's folder, the only place where Spark looks for a table's files.
FLAT = "flat-"


class RefusedError(RuntimeError):
    """Rows could not be loaded and nobody takes them back; nothing was changed."""


@dataclass
class LoadResult:
    """What one call did.

    ``rejected`` holds every row that was not loaded: with ``unit="row"`` the bad ones, else all rows of the refused
    loads or batches, ``_errors`` empty on the good ones. ``bad_rows`` counts those with errors, ``rejected_rows`` all. It
    can be read until ``close()``.
    """

    rows_written: int
    inserts: int
    duplicate_inserts: int
    failed_loads: int
    rejected_rows: int
    bad_rows: int
    rejected: DataFrame
    batches: DataFrame
    _scratch: Scratch

    def close(self) -> None:
        self._scratch.clear()


def read_target(spark: SparkSession, path: str, columns: list[ColumnSpec] | None = None) -> DataFrame:
    """The rows loaded so far, without the commit folder names.

    With ``columns``, a column added since reads as null in older rows.
    """
    if columns is None:
        return spark.read.parquet(path).drop(COMMIT)
    schema = T.StructType([T.StructField(s.name, storage_type(s.type)) for s in columns if not s.computed])
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{n}`") for n in schema.fieldNames()])


def load(
    df: DataFrame,
    path: str,
    columns: list[ColumnSpec],
    ledger_path: str,
    load_id: str = "load_id",
    order_by: list[str | Column] | None = None,
    max_rows: int = MAX_ROWS,
    token: str = "load_id",
    window: int | None = None,
    unit: str = "load",
    table: str | None = None,
    local_zone: str = "UTC",
    typed: bool = True,
    unique: bool = False,
    commit: str | None = None,
    reread: bool = False,
    refuse: bool = False,
    partition_by: list[str] | None = None,
) -> LoadResult:
    """Load the rows of ``df`` into the Parquet folder ``path``.

    ``load_id`` names the column that says which load a row belongs to; when ``df``
    has no such column, its value is the id of the one load the frame is. Columns of
    the target the records lack get their default. ``token``
    is ``"none"``, ``"load_id"`` or the name of a column.

    Data is written beside the target, then the ledger gets its rows as one entry of its log, then the data
    folder is moved to ``path/_commit=<id>``. A crash before the entry leaves nothing
    behind; after it, the next call (or ``recover``) finishes the move. A load run
    again under its token writes nothing, however many batches it has; when its id is its
    token and the ledger knows it as done, its rows are not even read (``reread`` reads them
    all the same, for their rejects). Without a token every call adds its rows,
    unless ``commit`` names the folder to replace.

    Several writers may load into one table. Each judges its batches by the ledger it has read and then tries for the log's
    next entry; who comes second reads what was added, judges again (the data stays written) and tries once more. A
    writer keeps a lease on its files while it works, so ``recover`` spares them.

    All rows of a load must have the same token; a load with several fails. With ``refuse``
    a row that cannot be loaded raises ``RefusedError`` before anything changes. ``partition_by`` names
    columns whose values become folders; the files of all of them belong to one entry. A call that
    fails adds a ledger row with its causes and the status ``retry`` or ``failed``.
    """
    try:
        return _load(df, path, columns, ledger_path, load_id, order_by, max_rows, token, window, unit, table, local_zone, typed, unique, commit, reread, refuse, partition_by or [])
    except (AlignmentError, RefusedError, ValueError):
        raise
    except Exception as error:
        note_failure(df.sparkSession, ledger_path, load_id, table or path.rstrip("/").rsplit("/", 1)[-1], error)
        raise


def load_table(df: DataFrame, table: str, ledger_path: str, **options) -> LoadResult:
    """``load`` into a table by its name: its columns, types and defaults are read afresh, its location is the target.

    ``options`` are those of ``load``. A column added since the last load is
    filled from then on, with its default where the records lack it. Statements on the table see the rows at once. The rows
    of a partitioned table are staged by partition; the log's entry is the journal by which a lost driver's moves are
    finished, for all partitions or for none, and partitions that are new are told to the catalog.
    """
    from quayside.operators.statements import location, partition_columns, recover_table
    from quayside.sources.readers import table_spec

    spark = df.sparkSession
    columns, parts = table_spec(spark, table), partition_columns(spark, table)
    recover_table(spark, table)
    try:
        return load(df, location(spark, table), columns, ledger_path, table=table, commit=f"{FLAT}{uuid.uuid4().hex}", partition_by=parts, **options)
    finally:
        if parts:
            spark.sql("ALTER TABLE IDENTIFIER(:t) RECOVER PARTITIONS", args={"t": table})
        spark.catalog.refreshTable(table)


def note_failure(spark: SparkSession, ledger_path: str, load_id: str, table: str, error: Exception) -> None:
    """The ledger row of a load that failed, once per error; when even that cannot be written, the first error stands."""
    if getattr(error, "_noted", False):
        return
    causes = L.cause_chain(error)
    status = L.RETRY if L.retryable_chain(causes) else L.FAILED
    try:
        at = Log(spark, ledger_path).snapshot()
        tried = L.read_ledger(spark, ledger_path, at).where((F.col("table") == table) & (F.col("load_id") == load_id)).agg(F.max("attempts")).first()[0]
        row = {
            "seq": at.next.get(table, 0), "table": table, "load_id": load_id, "token": None, "batch_index": 0, "rows": 0, "status": status,
            "attempts": (tried or 0) + 1, "causes": [(k, c, (m or "")[:2000]) for k, c, m in causes],
        }
        L.append_ledger([row], ledger_path.rstrip("/"), spark=spark)
        error._noted = True
    except Exception as second:  # noqa: BLE001
        error.add_note(f"the ledger could not be written either: {second}")


def _load(df, path, columns, ledger_path, load_id, order_by, max_rows, token, window, unit, table, local_zone, typed, unique, commit, reread, refuse, parts) -> LoadResult:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    path, ledger_path = path.rstrip("/"), ledger_path.rstrip("/")
    named = commit is not None and not commit.startswith(FLAT)
    spark, scratch, commit = df.sparkSession, Scratch(df.sparkSession), commit or uuid.uuid4().hex
    table = table or path.rsplit("/", 1)[-1]
    single = load_id not in df.columns
    if single and load_id == "load_id":
        raise ValueError("the frame has no column load_id; pass load_id='<id of this load>'")
    if single and order_by is None and unit == "prefix":
        raise ValueError("unit='prefix' needs order_by, so that a replay cuts the same batches")

    rows, chosen = _converted(df, columns, load_id, single, order_by or [], token, local_zone, typed, table)
    log = Log(spark, ledger_path)
    at = recover(spark, path, ledger_path)
    call = _Call(spark, log, path, ledger_path, table, commit, named, at.number, parts)
    history = L.read_ledger(spark, ledger_path, at).where(F.col("table") == table)
    own = _Own() if at.empty else None
    if single and token == "load_id" and window != 0 and not reread:
        own = own or _own(history, load_id, load_id, commit)
        if own.finished:
            return _replayed(rows.where(F.lit(False)), load_id, own, call, scratch)
    if refuse:
        bad = rows.where(is_bad()).limit(1).collect()
        if bad:
            raise RefusedError(f"a row cannot be loaded: {'; '.join(bad[0][ERRORS])}")
    with Lease(spark, path, commit):
        if single and unit != "prefix":
            result = _load_one(rows, chosen, call, load_id, max_rows, token, window, unit, at, own, scratch)
            if result is not None:
                return result
        return _load_cut(rows, chosen, call, order_by, max_rows, single, window, unit, unique, scratch)


def _load_cut(rows, chosen, call, order_by, max_rows, single, window, unit, unique, scratch) -> LoadResult:
    """Several loads at once, loads by prefix, and loads of which some batches are held back: the rows are cut first."""
    refused, bad = rows.where(F.lit(False)), 0
    if unit == "row":
        refused = scratch.keep(rows.where(is_bad()), "refused")
        rows, bad = rows.where(~is_bad()), refused.count()
    # cut, and write the cut rows once: every later step reads them back
    by_load = None if single else LOAD
    cut = cut_batches(rows, order_by if single else order_by or [], max_rows, by_load, unique=unique, scratch=scratch)
    if not single:
        cut = scratch.keep(cut, "cut")
    per_batch = cut.groupBy(F.col(LOAD).alias("load_id"), "batch_index").agg(
        batch_token(F.min(TOKEN), F.col("batch_index")).alias("token"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(is_bad(), 1).otherwise(0)).alias("bad"),
        F.min(TOKEN).alias("_low"),
        F.max(TOKEN).alias("_high"),
    )
    per_batch = scratch.keep(per_batch, "batches")
    # a load whose rows carry several tokens fails from its first batch on
    mixed = per_batch.groupBy(F.col("load_id").alias("_mixed")).agg(F.min("_low").alias("a"), F.max("_high").alias("b")).where("a <> b").select("_mixed")
    marked = per_batch.join(mixed, per_batch["load_id"].eqNullSafe(mixed["_mixed"]), "left")
    per_batch = marked.withColumn("bad", F.when(F.col("_mixed").isNotNull() & (F.col("batch_index") == 0) & (F.col("bad") == 0), 1).otherwise(F.col("bad"))).drop("_mixed", "_low", "_high")

    def judged(at: Snapshot) -> tuple[DataFrame, dict]:
        history = L.read_ledger(call.spark, call.ledger_path, at).where(F.col("table") == call.table)
        found = _judged(per_batch, history, call.table, unit, window, at.next.get(call.table), scratch)
        return found, _sums(found)

    def ready(batches: DataFrame, sums: dict) -> None:
        if L.ACCEPTED in sums:
            held = _total(sums, "batches", L.DUPLICATE, L.FAILED)
            call.stage(_accepted(cut, batches, held, chosen))

    batches, sums = call.settle(judged, ready)
    if unit != "row":
        bad = _total(sums, "bad", *sums)
        if L.FAILED in sums:
            out = hinted(batches.where(F.col("status") == L.FAILED).select(F.col("load_id").alias("_l"), F.col("batch_index").alias("_b")), sums[L.FAILED]["batches"])
            refused = cut.join(out, cut[LOAD].eqNullSafe(out["_l"]) & (cut["batch_index"] == out["_b"]), "left_semi").drop("batch_index")
    handed = bad if unit == "row" else _total(sums, "rows", L.FAILED)
    return _result(batches, sums, refused, bad, handed, scratch)


class _Call:
    """One call's way to its entry in the log."""

    def __init__(self, spark, log, path, ledger_path, table, commit, named, began, parts) -> None:
        self.spark, self.log, self.path, self.ledger_path, self.table = spark, log, path, ledger_path, table
        self.commit, self.named, self.began, self.parts = commit, named, began, parts

    def stage(self, rows: DataFrame) -> None:
        """Write rows beside the target. Those of a partition meet in few tasks, which Spark splits again where they are many."""
        if self.parts:
            rows = rows.hint("rebalance", *self.parts)
        rows.write.mode("overwrite").partitionBy(*self.parts).parquet(_staging(self.path, self.commit))

    def settle(self, judged, ready, at: Snapshot | None = None, rows=None) -> tuple[DataFrame | None, dict]:
        """Judge by a snapshot, make the data ready, and try for the entry after it, until no other writer was in between."""
        while True:
            at = at or self.log.snapshot()
            if at.undone(self.commit, self.began):
                raise RuntimeError(f"the files of call {self.commit} were cleared away while it worked; its lease had run out")
            batches, sums = judged(at)
            if not sums:
                return batches, sums
            ready(batches, sums)
            few = rows(at) if rows else None
            if few is None:
                few = _noted(batches, _total(sums, "batches", *sums))
            if self.named and _known(self.spark, self.ledger_path, at, [self.commit]):
                few = []  # the same call again, which replaces its folder: the ledger has its rows
            try:
                _publish(self.spark, few, self.path, self.ledger_path, self.commit, L.ACCEPTED in sums, at)
            except L.ConflictError:
                at = None
                continue
            return batches, sums


@dataclass
class _Own:
    """What the ledger says of one load and of the tokens it may come under."""

    last: str | None = None
    accepted: int = 0
    failed: int = 0
    other: int = 0
    known: int | None = None
    tried: int = 0
    rows: int = 0
    hits: int = 0

    @property
    def finished(self) -> bool:
        """Whether the load went in whole under its own id."""
        return self.last in (L.ACCEPTED, L.DUPLICATE) and bool(self.accepted) and not self.other and not self.failed and self.known == self.accepted


def _own(history: DataFrame, load_id: str, base: str | None, commit: str) -> _Own:
    mine, went_in = F.col("load_id") == load_id, F.col("status") == L.ACCEPTED
    base_col = F.lit(base).cast("string")
    under = (F.col("token") == base_col) | (F.startswith("token", F.concat(base_col, F.lit("-"))) & F.substr("token", F.length(base_col) + 2).rlike("^[0-9]+$"))
    found = history.withColumnRenamed("batches", "in_all").agg(
        F.max_by(F.when(mine, F.col("status")), F.when(mine, F.col("seq"))).alias("last"),
        F.count(F.when(mine & went_in, 1)).alias("accepted"), F.count(F.when(mine & (F.col("status") == L.FAILED), 1)).alias("failed"),
        F.count(F.when(mine & went_in & ~F.col("token").eqNullSafe(batch_token(F.lit(load_id), F.col("batch_index"))), 1)).alias("other"),
        F.max(F.when(mine & went_in, F.col("in_all"))).alias("known"), F.max(F.when(mine, F.col("attempts"))).alias("tried"),
        F.sum(F.when(mine & went_in, F.col("rows"))).alias("rows"), F.count(F.when(went_in & under, 1)).alias("hits"),
    ).first()
    return _Own(found["last"], found["accepted"], found["failed"], found["other"], found["known"], found["tried"] or 0, found["rows"] or 0, found["hits"])


def _replayed(nothing: DataFrame, load_id: str, own: _Own, call: _Call, scratch: Scratch) -> LoadResult:
    """A load that is known as done: its accepted batches once more, as duplicates."""

    def judged(at: Snapshot) -> tuple[DataFrame, dict]:
        history = L.read_ledger(call.spark, call.ledger_path, at).where((F.col("table") == call.table) & (F.col("load_id") == load_id) & (F.col("status") == L.ACCEPTED))
        again = history.select(
            (F.lit(at.next.get(call.table, 0)) + F.col("batch_index")).alias("seq"), "table", "load_id", "token", "batch_index", "rows", F.lit(0).cast("bigint").alias("bad"),
            F.lit(L.DUPLICATE).alias("status"), F.lit(own.tried + 1).alias("attempts"), F.col("load_id").alias("load_key"), "batches",
        )
        return again, {L.DUPLICATE: {"batches": own.accepted, "rows": own.rows, "loads": 1, "bad": 0}}

    batches, sums = call.settle(judged, lambda *_: None)
    return _result(batches, sums, nothing, 0, 0, scratch)


def _load_one(rows, chosen, call, load_id, max_rows, token, window, unit, at, own, scratch) -> LoadResult | None:
    """The common case: one load that goes in as a whole, or not at all.

    Its batches only exist in the ledger then, and follow from the number of rows, so the rows are written once, beside
    the target, and the folder is moved into place. None when the ledger holds some
    of the batches back; the caller then cuts the rows.
    """
    spark, staging = rows.sparkSession, _staging(call.path, call.commit)
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.when(is_bad(), 1).otherwise(0)).alias("bad"), F.min(TOKEN).alias("low"), F.max(TOKEN).alias("high"))
    good = counted.where(~is_bad()).select(*[F.col(f"`{s.name}`") for s in chosen])
    wanted = False
    try:
        call.stage(good)
        found = dict(seen.get)
        if call.parts:  # an observation below a shuffle may count a repeated task twice
            found["rows"] = spark.read.schema(good.schema).parquet(staging).count() + (found["bad"] or 0)
        mixed = found["low"] != found["high"]
        refused, bad, handed = rows.where(F.lit(False)), 0, 0
        if found["bad"] or mixed:
            refused = rows.where(is_bad()) if unit == "row" and not mixed else rows
            if mixed:
                refused = refused.withColumn(ERRORS, F.array_append(ERRORS, F.lit(f"the rows of load '{load_id}' carry several tokens")))
            refused = scratch.keep(refused, "refused")
            handed, bad = refused.agg(F.count(F.lit(1)), F.count(F.when(is_bad(), 1))).first()
        whole = unit == "load"
        total = found["rows"] - (0 if whole else found["bad"] or 0)
        n = -(-total // max_rows)
        base = load_id if token == "load_id" else found["low"] if token != "none" else None
        fails = n > 0 and bool(bad) and (whole or mixed)
        attempts = first = 0
        general = False

        def judged(now: Snapshot) -> tuple[DataFrame | None, dict]:
            nonlocal attempts, first, own, at, general, wanted
            if now.number != at.number or own is None:
                history = L.read_ledger(spark, call.ledger_path, now).where(F.col("table") == call.table)
                own, at = _Own() if now.empty else _own(history, load_id, base, call.commit), now
            attempts, first = own.tried + 1, now.next.get(call.table, 0)
            general = bool(own.hits) and base is not None and window != 0 and not fails and n > 0
            if general or not n:
                return None, {}
            status = L.FAILED if fails else L.ACCEPTED
            wanted = not fails  # from here on the files may be in the log
            return _arithmetic(spark, load_id, call.table, base, n, total, max_rows, bad if fails else 0, first, attempts, status), {
                status: {"batches": n, "rows": total, "loads": 1, "bad": bad if fails else 0}
            }

        def few(now: Snapshot) -> list[dict] | None:
            if n > INLINE_ROWS:
                return None
            causes = [[_cause(bad if k == 0 else 0)] if fails else [] for k in range(n)]
            tokens = [None if base is None else base if k == 0 else f"{base}-{k}" for k in range(n)]
            return [
                {
                    "seq": first + k, "table": call.table, "load_id": load_id, "token": tokens[k], "batch_index": k, "rows": min(max_rows, total - k * max_rows),
                    "status": L.FAILED if fails else L.ACCEPTED, "attempts": attempts, "causes": causes[k], "batches": n,
                }
                for k in range(n)
            ]

        batches, sums = call.settle(judged, lambda *_: None, at, few)
        if general:
            wanted = True
            batches, sums = _hit_by_others(call, n, total, max_rows, load_id, base, window, scratch)
        wanted = L.ACCEPTED in sums
        if len(sums) > 1:
            wanted = False
            return None
        if batches is None:
            batches = _arithmetic(spark, load_id, call.table, base, 0, 0, max_rows, 0, 0, 1, L.ACCEPTED)
        return _result(batches, sums, refused, bad, handed, scratch)
    finally:
        if not wanted:
            Storage(spark).delete(staging)
            Storage(spark).delete_if_empty(f"{call.path}/{STAGING}")


def _hit_by_others(call, n, total, max_rows, load_id, base, window, scratch) -> tuple[DataFrame, dict]:
    """Batches of a load of which the ledger knows some tokens; nothing is settled when only some of them are held back."""

    def judged(now: Snapshot) -> tuple[DataFrame, dict]:
        history = L.read_ledger(call.spark, call.ledger_path, now).where(F.col("table") == call.table)
        per_batch = _arithmetic(call.spark, load_id, call.table, base, n, total, max_rows, 0, 0, 1, "").select("load_id", "batch_index", "token", "rows", "bad")
        found = _judged(per_batch, history, call.table, "load", window, now.next.get(call.table), scratch, once=True)
        sums = _sums(found)
        return found.withColumn("batches", F.lit(n).cast("bigint")), sums if len(sums) == 1 else {}

    found, sums = call.settle(judged, lambda *_: None)
    return found, sums or _sums(found)


def _arithmetic(spark, load_id, table, base, n, total, max_rows, bad, first, attempts, status) -> DataFrame:
    """The batches of a load that is cut in order: they follow from its number of rows."""
    index = F.col("id")
    return spark.range(0, n, 1, max(1, n // BROADCAST_ROWS)).select(
        (F.lit(first) + index).alias("seq"),
        F.lit(table).alias("table"),
        F.lit(load_id).alias("load_id"),
        index.alias("batch_index"),
        batch_token(F.lit(base).cast("string"), index).alias("token"),
        F.least(F.lit(max_rows), F.lit(total) - index * max_rows).cast("bigint").alias("rows"),
        F.when(index == 0, bad).otherwise(0).cast("bigint").alias("bad"),
        F.lit(status).alias("status"),
        F.lit(attempts).alias("attempts"),
        F.lit(load_id).alias("load_key"),
        F.lit(n).cast("bigint").alias("batches"),
    )


STAGING = "_staging"


def _staging(path: str, commit: str) -> str:
    return f"{path}/{STAGING}/{commit}"


class Lease:
    """A sign beside a call's files that its writer is at work, renewed while it is; ``recover`` spares such files.

    Times are those of the table's file system, so clocks need not agree.
    """

    SECONDS = 120

    def __init__(self, spark: SparkSession, path: str, commit: str) -> None:
        self.files, self.sign, self.folder = Storage(spark), f"{path}/{STAGING}/{commit}.lease", f"{path}/{STAGING}"
        self._done = threading.Event()

    def _renew(self) -> None:
        while not self._done.wait(self.SECONDS / 4):
            try:
                self.files.write_text(self.sign, "at work")
            except Exception:  # noqa: BLE001  the next turn tries again; a lease that ends is noticed at the commit
                continue

    def __enter__(self) -> Lease:
        self.files.write_text(self.sign, "at work")
        self._thread = threading.Thread(target=self._renew, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._done.set()
        self._thread.join()
        self.files.delete(self.sign)
        self.files.delete_if_empty(self.folder)


def _publish(spark: SparkSession, rows, path: str, ledger_path: str, commit: str, data: bool, after: Snapshot) -> None:
    """Make one call's work visible: first the ledger, which decides, then the data."""
    L.append_ledger(rows, ledger_path, commit, after, spark)
    if data:
        _show(spark, path, commit)


def _show(spark: SparkSession, path: str, commit: str) -> None:
    """Move a call's files to where readers look. Done already, it does nothing."""
    files, folder, staging = Storage(spark), f"{path}/{COMMIT}={commit}", _staging(path, commit)
    if not files.exists(staging):
        return
    if commit.startswith(FLAT):  # file by file, each under its partition; what a lost driver left over, ``recover`` moves
        for name in files.below(staging, ".parquet"):
            folders, _, file = name.rpartition("/")
            files.move(f"{staging}/{name}", "/".join(x for x in (path, folders, f"{commit}-{file}") if x))
        files.delete(staging)
        return
    files.delete(folder)
    files.move(staging, folder)


def _known(spark: SparkSession, ledger_path: str, at: Snapshot, commits: list[str]) -> set[str]:
    """Which of the calls have an entry in the log."""
    found = {e["commit"] for e in at.tail if e.get("commit") in commits}
    if at.parts and set(commits) - found:
        rows = L.read_ledger(spark, ledger_path, at).where(F.col("commit").isin(*commits))
        found |= {r["commit"] for r in rows.select("commit").distinct().collect()}
    return found


def recover(spark: SparkSession, path: str, ledger_path: str) -> Snapshot:
    """Finish or undo what a crashed call left: data the ledger knows is moved into place, the rest is removed.

    Files under a lease are left alone. Before files are removed the log says so, which stops a writer that was only slow.
    Gives the log as it is then.
    """
    files, log = Storage(spark), Log(spark, ledger_path)
    at = log.snapshot()
    names = files.children(f"{path}/{STAGING}")
    if not names:
        return at
    now = None
    left = []
    for name in sorted({n.removesuffix(".lease") for n in names if not n.endswith((".tmp", ".crc"))}):
        signed = files.modified(f"{path}/{STAGING}/{name}.lease")
        if signed is not None:
            if now is None:
                probe = f"{path}/{STAGING}/{uuid.uuid4().hex}.probe.tmp"
                files.write_text(probe, "")
                now = files.modified(probe)
                files.delete(probe)
            if now - signed < Lease.SECONDS * 1000:
                continue
        left.append(name)
    while left:
        known = _known(spark, ledger_path, at, left)
        lost = [n for n in left if n not in known]
        if lost and not log.put({"commit": uuid.uuid4().hex, "undone": lost}, at):
            at = log.snapshot()
            continue
        for name in left:
            if name in known:
                _show(spark, path, name)
            files.delete(_staging(path, name))
            files.delete(f"{path}/{STAGING}/{name}.lease")
        files.delete_if_empty(f"{path}/{STAGING}")
        return log.snapshot()
    return at


def _sums(batches: DataFrame) -> dict:
    """Counts of batches, rows, loads and bad rows per status."""
    found = batches.groupBy("status").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"), F.count_distinct("load_key").alias("loads"), F.sum("bad").alias("bad")
    )
    return {r["status"]: r for r in found.collect()}


def _total(sums: dict, field: str, *statuses: str) -> int:
    return sum(sums[s][field] for s in statuses if s in sums)


def _result(batches: DataFrame, sums: dict, refused: DataFrame, bad: int, handed: int, scratch: Scratch) -> LoadResult:
    return LoadResult(
        rows_written=_total(sums, "rows", L.ACCEPTED, L.DUPLICATE),
        inserts=_total(sums, "batches", L.ACCEPTED, L.DUPLICATE),
        duplicate_inserts=_total(sums, "batches", L.DUPLICATE),
        failed_loads=_total(sums, "loads", L.FAILED),
        rejected_rows=handed,
        bad_rows=bad,
        rejected=refused.drop(TOKEN).withColumnRenamed(LOAD, "load_id"),
        batches=batches.drop("load_key", "batches"),
        _scratch=scratch,
    )


def _converted(df, columns, load_id, single, order_by, token, zone, typed, table) -> tuple[DataFrame, list[ColumnSpec]]:
    """Aligned and converted rows with their load id, base token and defaults, and the columns they fill."""
    names = {s.name for s in columns}
    told = [UNREADABLE] if UNREADABLE in df.columns else []
    helpers = {load_id, token, *told, *[c for c in order_by if isinstance(c, str)]}
    fields = [c for c in df.columns if c in names or c not in helpers]
    chosen = insertable(fields, columns, table, typed)
    source = df.withColumn(LOAD, F.lit(load_id) if single else F.col(f"`{load_id}`").cast("string"))
    source = source.withColumn(TOKEN, base_token(token, LOAD))
    sort_only = [c for c in order_by if isinstance(c, str) and c not in names]
    rows = conform(source, chosen, zone, keep=[LOAD, TOKEN, *sort_only, *told])
    absent = {s.name: default_column(s) for s in columns if not s.computed and s not in chosen}
    if absent:
        rows, chosen = rows.withColumns(absent), [s for s in columns if not s.computed]
    if token != "none":
        # a load without its token fails like one with a bad value
        missing = token_error(TOKEN, shown=load_id if token == "load_id" else token)
        rows = rows.withColumn(ERRORS, F.when(missing.isNull(), F.col(ERRORS)).otherwise(F.array_append(ERRORS, missing)))
    return rows, chosen


def _judged(per_batch: DataFrame, history: DataFrame, table: str, unit: str, window: int | None, following: int | None, scratch: Scratch, once: bool = False) -> DataFrame:
    """The batches with their sequence number and status; ``following`` is the table's next number, None when it has no rows."""
    last = None if following is None else following - 1
    if last is None and once:
        window = 0  # nothing loaded yet and no token twice
    per_batch = per_batch.withColumn("table", F.lit(table))
    # one load's batches are numbered already
    in_order = per_batch.withColumn("seq", F.col("batch_index")) if once else with_row_index(per_batch, ["load_id", "batch_index"], "seq", unique=True, scratch=scratch)
    arrivals = in_order.withColumn("seq", F.col("seq") + F.lit(0 if last is None else last + 1)).withColumn("attempts", F.lit(1))
    if last is not None:
        tried = history.groupBy(F.col("load_id").alias("_tried")).agg(F.max("attempts").alias("_times"))
        arrivals = arrivals.join(tried, arrivals["load_id"] == tried["_tried"], "left")
        arrivals = arrivals.withColumn("attempts", F.coalesce("_times", F.lit(0)) + 1).drop("_tried", "_times")

    fails = arrivals.where("bad > 0").groupBy(F.col("load_id").alias("_failed")).agg(F.min("batch_index").alias("first_bad"))
    late = F.col("first_bad").isNotNull() if unit == "load" else F.coalesce(F.col("batch_index") >= F.col("first_bad"), F.lit(False))
    arrivals = arrivals.join(fails, arrivals["load_id"].eqNullSafe(fails["_failed"]), "left")
    arrivals = arrivals.withColumn("blocked", late).drop("_failed", "first_bad")

    checked = L.dedup(arrivals.where(~F.col("blocked")), history, window, scratch=scratch)
    passed = checked.withColumn("status", F.when(F.col("accepted"), L.ACCEPTED).otherwise(L.DUPLICATE)).drop("accepted")
    failed = arrivals.where("blocked").withColumn("status", F.lit(L.FAILED))
    judged = passed.unionByName(failed).drop("blocked").withColumn("load_key", F.coalesce("load_id", F.lit("")))
    return scratch.keep(judged, "judged")


def _accepted(cut: DataFrame, batches: DataFrame, held: int, chosen: list[ColumnSpec]) -> DataFrame:
    """The rows of the accepted batches."""
    if held:
        out = batches.where(F.col("status") != L.ACCEPTED).select(F.col("load_id").alias("_l"), F.col("batch_index").alias("_b"))
        out = hinted(out, held)
        cut = cut.join(out, cut[LOAD].eqNullSafe(out["_l"]) & (cut["batch_index"] == out["_b"]), "left_anti")
    return cut.select(*[F.col(f"`{s.name}`") for s in chosen])


def _cause(bad: int) -> tuple[str, None, str]:
    return ("data", None, f"rows that could not be converted in this batch: {bad}")


def _noted(batches: DataFrame, count: int) -> DataFrame | list[dict]:
    """Judged batches as ledger rows; in hand while they are few."""
    if count <= INLINE_ROWS:
        fields = [c for c in batches.columns if c not in ("load_key", "bad")]
        return [r.asDict() | {"causes": [_cause(r["bad"])] if r["status"] == L.FAILED else []} for r in batches.select(*fields, "bad").collect()]
    why = F.concat(F.lit("rows that could not be converted in this batch: "), F.col("bad").cast("string"))
    cause = F.struct(F.lit("data").alias("kind"), F.lit(None).cast("int").alias("code"), why.alias("message"))
    none = F.array().cast(f"array<{L.CAUSE}>")
    noted = batches.withColumn("causes", F.when(F.col("status") == L.FAILED, F.array(cause)).otherwise(none))
    return noted.withColumn("ts", F.current_timestamp())
