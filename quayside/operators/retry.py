"""Failed loads run again: those the ledger calls due, a bounded number of times, the rest handed back."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import ledger as L
from quayside.operators.load import LoadResult, note_failure


def due_loads(spark: SparkSession, ledger_path: str, table: str, max_attempts: int) -> DataFrame:
    """(load_id, attempts): loads whose last ledger row asks for a retry and that had fewer than ``max_attempts``."""
    state = _state(spark, ledger_path, table)
    return state.where((F.col("status") == L.RETRY) & (F.col("attempts") < max_attempts)).select("load_id", "attempts")


def given_up(spark: SparkSession, ledger_path: str, table: str, max_attempts: int) -> DataFrame:
    """(load_id, status, attempts, error): loads that failed for good, or as often as they may."""
    state = _state(spark, ledger_path, table)
    out = state.where((F.col("status") == L.FAILED) | ((F.col("status") == L.RETRY) & (F.col("attempts") >= max_attempts)))
    return L.error_message(out).select("load_id", "status", "attempts", "error")


def _state(spark: SparkSession, ledger_path: str, table: str) -> DataFrame:
    mine = L.read_ledger(spark, ledger_path).where(F.col("table") == table)
    return mine.groupBy("load_id").agg(F.max_by("status", "seq").alias("status"), F.max("attempts").alias("attempts"), F.max_by("causes", "seq").alias("causes"))


def run_loads(
    spark: SparkSession,
    ledger_path: str,
    table: str,
    attempt: Callable[[str], LoadResult],
    load_ids: Iterable[str] = (),
    max_attempts: int = 10,
    pause: Callable[[int], float] = lambda tried: min(60.0, 2.0**tried),
) -> DataFrame:
    """Run ``attempt(load_id)``, which calls ``load`` under that id, for new loads and then for those that are due.

    A failure is noted in the ledger, by ``load`` or, when it happens before it, here; what may pass is tried again under its
    old id and tokens, ``pause(attempts)`` seconds later, until it went in or had ``max_attempts``. The rounds go on from
    the ledger, so a driver that is lost and starts anew counts earlier attempts. Gives the loads that are ``given_up``.
    """
    for load_id in load_ids:
        _try(spark, ledger_path, table, attempt, load_id)
    while True:
        due = due_loads(spark, ledger_path, table, max_attempts)
        tried = None
        for row in due.toLocalIterator():
            time.sleep(max(0.0, pause(row["attempts"])))
            _try(spark, ledger_path, table, attempt, row["load_id"])
            tried = row["load_id"]
        if tried is None:
            return given_up(spark, ledger_path, table, max_attempts)


def _try(spark: SparkSession, ledger_path: str, table: str, attempt: Callable[[str], LoadResult], load_id: str) -> None:
    try:
        attempt(load_id).close()
    except Exception as error:  # noqa: BLE001  the ledger has it, and says whether it is tried again
        note_failure(spark, ledger_path, load_id, table, error)
        error._noted = False  # the same error may come back from the next attempt
