"""The load ledger: which batches a table has accepted, and what to do with a failed load.

One ledger row per batch and attempt. Everything here works on such rows, a
hundred-thousandth of the data at the default batch size.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.index import with_group_index
from quayside.operators.log import MERGE_AFTER, Log, Snapshot
from quayside.plans.session import Scratch
from quayside.plans.storage import Storage

CAUSE = "struct<kind: string, code: int, message: string>"
LEDGER_SCHEMA = (
    "seq bigint, table string, load_id string, token string, batch_index bigint, rows bigint, status string, "
    f"attempts int, causes array<{CAUSE}>, ts timestamp"
)
ACCEPTED, DUPLICATE, FAILED, RETRY = "accepted", "duplicate", "failed", "retry"

# Server error codes and failure kinds worth another attempt.
RETRYABLE_CODES = (159, 209, 241, 252)  # timeout exceeded, socket timeout, memory limit exceeded, too many parts
NETWORK_KINDS = ("connect", "transport", "transfer")
SERVER_KIND = "server"


FULL_SCHEMA = f"{LEDGER_SCHEMA}, batches bigint, commit string"
_FIELDS = ("seq", "table", "load_id", "token", "batch_index", "rows", "status", "attempts", "causes", "ts", "batches", "commit")


class ConflictError(RuntimeError):
    """Another writer added to the log since it was read."""


def read_ledger(spark: SparkSession, path: str, at: Snapshot | None = None) -> DataFrame:
    """The ledger at ``path``, or as it was in a snapshot; empty when nothing was loaded yet.

    ``batches`` tells how many batches a row's load had in all, where the call knew it; ``commit`` names the folder its data
    went to.
    """
    log = Log(spark, path)
    return log.rows(at or log.snapshot(), FULL_SCHEMA)


def append_ledger(rows: DataFrame | list[dict], path: str, commit: str | None = None, after: Snapshot | None = None, spark: SparkSession | None = None) -> None:
    """Add the rows of one call. They appear all at once, as one entry of the log.

    With ``after`` the entry must be the next one after that snapshot, else ``ConflictError``; without it the rows go in
    behind whatever is there. Rows in hand (few) are part of the entry, a frame is written as a part of the ledger.
    """
    spark = spark or rows.sparkSession
    log, commit = Log(spark, path), commit or uuid.uuid4().hex
    entry: dict = {"commit": commit}
    if isinstance(rows, list):
        now = time.time()
        entry["rows"] = [[(r.get(f) if f not in ("ts", "commit") else now if f == "ts" else commit) for f in _FIELDS] for r in rows]
        entry["count"] = len(rows)
        last: dict[str, int] = {}
        for r in rows:
            last[r["table"]] = max(last.get(r["table"], -1), r["seq"])
    else:
        known = "batches" if "batches" in rows.columns else "cast(null as bigint) as batches"
        full = rows.selectExpr("seq", "table", "load_id", "token", "batch_index", "rows", "status", "attempts", "causes", "ts", known).withColumn("commit", F.lit(commit))
        entry["part"] = log.write_part(full)
        sums = spark.read.schema(FULL_SCHEMA).parquet(f"{log.path}/{entry['part']}").groupBy("table").agg(F.max("seq").alias("last"), F.count(F.lit(1)).alias("n")).collect()
        last = {r["table"]: r["last"] for r in sums if r["last"] is not None}
        entry["count"] = sum(r["n"] for r in sums)
    at = after or log.snapshot()
    while True:
        entry["next"] = {t: max(n + 1, at.next.get(t, 0)) for t, n in last.items()}
        if log.put(entry, at):
            break
        if after is not None:
            if "part" in entry:
                Storage(spark).delete(f"{log.path}/{entry['part']}")
            raise ConflictError(f"another writer added entry {at.number + 1} to {path}")
        at = log.snapshot()
    if len(at.tail) + 1 >= MERGE_AFTER:
        log.merge(FULL_SCHEMA)


def recent_tokens(ledger: DataFrame, window: int, scratch: Scratch | None = None) -> DataFrame:
    """(table, token, age): the last ``window`` accepted tokens of each table, age 1 the newest."""
    accepted = ledger.where((F.col("status") == ACCEPTED) & F.col("token").isNotNull()).select("table", "token", "seq")
    ranked = with_group_index(accepted, ["table"], [F.desc("seq")], "_newer", True, scratch)
    return ranked.where(F.col("_newer") < window).select("table", "token", (F.col("_newer") + 1).cast("int").alias("age"))


def _counted(arrivals: DataFrame, ledger: DataFrame, window: int | None, scratch: Scratch) -> DataFrame:
    """The (table, token) pairs that arrivals are compared with."""
    accepted = ledger.where((F.col("status") == ACCEPTED) & F.col("token").isNotNull())
    if window is None:
        return accepted.select("table", "token").distinct()
    recent = recent_tokens(ledger, window, scratch).select("table", "token")
    if "load_id" in arrivals.columns:
        own = arrivals.select("table", "load_id").distinct()
        recent = recent.unionByName(accepted.join(own, ["table", "load_id"], "left_semi").select("table", "token"))
    return recent.distinct()


def dedup(arrivals: DataFrame, ledger: DataFrame, window: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Add ``accepted``: false for a batch whose token counts already.

    ``arrivals`` holds one row per batch: ``table``, ``seq`` (arrival order), ``token`` and perhaps ``load_id``. A token is a
    duplicate when the ledger counts it at the start of the call, or when it came earlier in the call, whatever the batch
    contains. By default every accepted token of a table counts. A ``window`` leaves only the last so many of other loads;
    those of a load that arrives again always count, so a load is never written twice. A null token or ``window=0``
    switches the check off.
    """
    if window is not None and window < 0:
        raise ValueError("window must not be negative")
    if window == 0:
        return arrivals.withColumn("accepted", F.lit(True))
    scratch = scratch or Scratch(arrivals.sparkSession)
    first = arrivals.where(F.col("token").isNotNull()).groupBy("table", "token").agg(F.min("seq").alias("seq"))
    new = first.join(_counted(arrivals, ledger, window, scratch), ["table", "token"], "left_anti")
    new = new.select(F.col("table").alias("_table"), F.col("token").alias("_token"), F.col("seq").alias("_seq"))
    match = (arrivals["table"] == new["_table"]) & (arrivals["token"] == new["_token"]) & (arrivals["seq"] == new["_seq"])
    joined = arrivals.join(new, match, "left")
    return joined.select(*[arrivals[c] for c in arrivals.columns], (F.col("token").isNull() | F.col("_seq").isNotNull()).alias("accepted"))


def load_summary(batches: DataFrame) -> DataFrame:
    """Rows and batches per load. A batch dropped as a duplicate still reports its rows."""
    return batches.groupBy("load_id").agg(
        F.sum("rows").alias("rows_written"),
        F.count(F.lit(1)).alias("inserts"),
        F.sum(F.when(F.col("status") == DUPLICATE, 1).otherwise(0)).alias("duplicates"),
    )


def _first_known(causes: Column) -> Column:
    known = F.filter(causes, lambda c: (c.kind == SERVER_KIND) | c.kind.isin(*NETWORK_KINDS))
    return F.try_element_at(known, F.lit(1))


def retryable(causes: Column, codes: tuple[int, ...] = RETRYABLE_CODES) -> Column:
    """Whether a failure may pass on another attempt: the first server or network cause of the chain decides."""
    first = _first_known(causes)
    by_code = F.coalesce(first.code.isin(*codes), F.lit(False))
    return F.when(first.isNull(), False).when(first.kind == SERVER_KIND, by_code).otherwise(True)


def server_error(causes: Column) -> Column:
    """Whether the server itself reported the failure."""
    return F.coalesce(F.exists(causes, lambda c: c.kind == SERVER_KIND), F.lit(False))


def failure_message(causes: Column) -> Column:
    """The outer message (its kind when it has none), plus the root's message when that adds something."""
    outer, root = F.try_element_at(causes, F.lit(1)), F.try_element_at(causes, F.lit(-1))
    head = F.coalesce(outer.message, outer.kind)
    adds = (F.size(causes) > 1) & root.message.isNotNull() & ~F.contains(head, root.message)
    return F.when(adds, F.concat_ws(": ", head, root.message)).otherwise(head)


def classify(ledger: DataFrame) -> DataFrame:
    """Add ``retryable`` and ``server_error`` from the ``causes`` column (outermost cause first)."""
    return ledger.withColumn("retryable", retryable(F.col("causes"))).withColumn("server_error", server_error(F.col("causes")))


def error_message(ledger: DataFrame) -> DataFrame:
    """Add ``error``, null for a row without causes."""
    return ledger.withColumn("error", F.when(F.size("causes") > 0, failure_message(F.col("causes"))))


def retry_select(pending: DataFrame, ledger: DataFrame, max_attempts: int = 10) -> DataFrame:
    """The pending rows whose load is due for another attempt under its old id and tokens.

    A load is due when its last ledger row asks for a retry and it had fewer than
    ``max_attempts`` attempts. Pending rows with a ``table`` column are matched by table as well.
    """
    by = ["table", "load_id"] if "table" in pending.columns and "table" in ledger.columns else ["load_id"]
    state = ledger.groupBy(*by).agg(
        F.max_by("status", "seq").alias("_last"), F.max("attempts").alias("_attempts")
    )
    due = state.where((F.col("_last") == RETRY) & (F.col("_attempts") < max_attempts)).select(*by)
    return pending.join(due, by, "left_semi")


def cause_chain(error: BaseException) -> list[tuple[str, int | None, str | None]]:
    """(kind, code, message) of an exception and what caused it, outermost first; network failures get their kind."""
    out: list[tuple[str, int | None, str | None]] = []
    seen: set[int] = set()
    while error is not None and id(error) not in seen and len(out) < 20:
        seen.add(id(error))
        java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
        while java is not None and hasattr(java, "getCause") and len(out) < 20:
            out.append((_kind(java.getClass().getSimpleName()), None, java.getMessage()))
            java = java.getCause()
        if not out or error.__cause__ is not None or not hasattr(error, "_origin"):
            out.append((_kind(type(error).__name__), None, str(error) or None))
        error = error.__cause__ or error.__context__
    return out


# Exception names that mean the network.
_NETWORK_NAMES = {
    "ConnectException": "connect", "NoRouteToHostException": "connect", "UnknownHostException": "connect", "ConnectionRefusedError": "connect",
    "SocketException": "transport", "SocketTimeoutException": "transport", "TimeoutException": "transport", "TimeoutError": "transport",
    "ConnectionResetError": "transport", "EOFException": "transfer", "ClosedChannelException": "transfer", "BrokenPipeError": "transfer",
}


def _kind(name: str) -> str:
    return _NETWORK_NAMES.get(name, name)


def retryable_chain(causes: list[tuple[str, int | None, str | None]], codes: tuple[int, ...] = RETRYABLE_CODES) -> bool:
    """``retryable`` for a chain in hand."""
    known = [(k, c) for k, c, _ in causes if k == SERVER_KIND or k in NETWORK_KINDS]
    return bool(known) and (known[0][0] != SERVER_KIND or known[0][1] in codes)
