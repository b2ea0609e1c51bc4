"""The load path under Structured Streaming: one micro-batch is one load."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.functions.convert import ERRORS
from quayside.operators.batches import MAX_ROWS
from quayside.operators.load import LoadResult, load
from quayside.streaming.buffer import Pending
from quayside.types import ColumnSpec


class StreamSettingError(ValueError):
    """Settings that contradict each other."""


def drop_replayed(stream: DataFrame, keys: list[str], event_time: str, horizon: str) -> DataFrame:
    """Drop records seen before within ``horizon`` of event time; the state kept is bounded by it."""
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(keys)


def stream_load(
    stream: DataFrame,
    path: str,
    columns: list[ColumnSpec],
    ledger_path: str,
    checkpoint: str,
    name: str,
    max_rows: int = MAX_ROWS,
    trigger: dict | None = None,
    buffer: str | None = None,
    token: str = "load_id",
    window: int | None = None,
    unit: str = "row",
    order_by: list[str | Column] | None = None,
    rejected_path: str | None = None,
    local_zone: str = "UTC",
    typed: bool = True,
    on_batch: Callable[[LoadResult, int], None] | None = None,
    pending_path: str | None = None,
    pending_rows: int = MAX_ROWS,
    pending_age: float = 60.0,
) -> StreamingQuery:
    """Load a stream into ``path``; a micro-batch run again after a crash writes nothing twice.

    Its load id and token are ``<name>-<query id>-<batch id>``; the query id is the checkpoint's own, so a restart goes on
    where it was and a new checkpoint is a new stream, under whatever name. The name becomes part of folder names:
    letters, digits, ``-`` and ``_``.
    ``trigger`` is what ``writeStream.trigger`` takes, by default
    ``availableNow``. ``buffer`` (``"1 minute"``) gathers small units over that time
    into one write instead; it is refused together with a token, which would promise a
    replay check per unit.

    With ``pending_path`` micro-batches wait there until they have ``pending_rows`` rows or the oldest is ``pending_age`` seconds
    old (looked at while the stream is idle, too), then go in as one load ``<name>-<query id>-<first>-<last>``, and are cleared after it;
    ``on_batch`` gets the last number. A crash at any point neither loses nor doubles them. What still waits when the stream ends is
    loaded by its next start under the same checkpoint, or by ``pending_units(...).flush()``.

    Rows that are not loaded go to ``rejected_path`` with their reasons: the bad ones, with ``unit="load"`` all of a
    micro-batch that has one (no reasons on the good rows). A batch run again writes them again in the same
    place. Without ``rejected_path`` a row that cannot be loaded stops the stream, before anything of its batch is loaded.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", name):
        raise StreamSettingError(f"the name {name!r} may only have letters, digits, '-' and '_'")
    if buffer is not None and token != "none":
        raise StreamSettingError("buffering cannot be combined with a token; pass token='none'")
    if pending_path is not None and (buffer is not None or pending_rows < 1 or pending_age < 0):
        raise StreamSettingError("pending_path goes without buffer, with a positive number of rows and an age of 0 or more")
    if buffer is not None and trigger is not None:
        raise StreamSettingError("buffer sets the trigger; pass one of the two")

    ids: dict[str, str] = {}

    def query_id(rows: DataFrame) -> str:
        if not ids:
            told = rows.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
            ids["own"] = json.loads(told)["id"].replace("-", "")
        return ids["own"]

    def write(rows: DataFrame, batch_id: int | str) -> None:
        load_id = f"{name}-{query_id(rows)}-{batch_id}"

        result = load(
            rows, path, columns, ledger_path, load_id=load_id, order_by=order_by, max_rows=max_rows, token=token,
            window=window, unit=unit, local_zone=local_zone, typed=typed, reread=True, refuse=rejected_path is None,
            commit=load_id if token == "none" else None,
        )
        try:
            if rejected_path and result.rejected_rows:
                record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record")
                back = result.rejected.select(F.lit(load_id).alias("load"), record, ERRORS)
                back.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(rejected_path)
            if on_batch:
                on_batch(result, int(str(batch_id).rsplit("-", 1)[-1]))
        finally:
            result.close()

    when = {"processingTime": buffer} if buffer else (trigger or {"availableNow": True})
    if pending_path is None:
        return stream.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**when).start()
    pending = Pending(stream.sparkSession, pending_path, pending_rows, pending_age, write)
    query = stream.writeStream.queryName(name).foreachBatch(pending.add).option("checkpointLocation", checkpoint).trigger(**when).start()
    _PENDING[str(query.runId)] = pending
    pending.watch(query, min(pending_age / 2, 10.0))
    return query


_PENDING: dict[str, Pending] = {}


def pending_units(query: StreamingQuery) -> Pending:
    """The units that wait for a load of this query, which was started with a ``pending_path`` in this session."""
    return _PENDING[str(query.runId)]
