"""Parameterised queries, one at a time or driven by a control frame."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from quayside.functions.normalize import refuse_duplicates
from quayside.operators.ledger import cause_chain, retryable_chain
from quayside.plans.storage import Storage


class QueryError(ValueError):
    """A query cannot be run."""


def run_query(spark: SparkSession, sql: str | None, args: dict | None = None) -> DataFrame:
    """``spark.sql`` with bound arguments. ``IDENTIFIER(:table)`` takes a table name as an argument."""
    if sql is None or not sql.strip():
        raise QueryError("no SQL query")
    result = spark.sql(sql, args=args or {})
    refuse_duplicates(result)
    return result


def run_queries(
    spark: SparkSession,
    control: DataFrame,
    sql: str = "sql",
    args: list[str] | None = None,
    keep: list[str] | None = None,
) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """Run one query per control row: (results, rejected, control).

    ``sql`` is the column with the query, or the query itself when the control frame
    has no such column; ``args`` are the columns bound to its parameters, ``keep`` the
    columns copied to every result row. Rows without a query are rejected and start
    nothing; a query that fails to compile rejects its row with the error while the others go on. The control frame
    comes back with a ``query_id`` per row that ran.

    This is for control frames one would run by hand: each row adds a branch to the
    plan. When only a key varies use ``run_per_key``, which is one join.
    """
    per_row = sql in control.columns
    text = F.col(f"`{sql}`") if per_row else F.lit(sql)
    blank = text.isNull() | text.rlike(r"^\s*$")
    results, marked, failed = [], [], []
    for name in [*(args or []), *(keep or [])]:
        if name not in control.columns:
            raise QueryError(f"the control frame has no column '{name}'")
    for row in control.where(~blank).toLocalIterator():
        try:
            result = run_query(spark, row[sql] if per_row else sql, {a: row[a] for a in args or []})
        except Exception as error:  # noqa: BLE001
            failed.append((*row, str(error).split("\n")[0][:1000]))
            continue
        tags = [F.lit(row[k]).cast(control.schema[k].dataType).alias(k) for k in keep or []]
        query_id = uuid.uuid4().hex
        results.append(result.select(*tags, *[F.col(f"`{c}`") for c in result.columns]))
        marked.append((*row, query_id))
    rejected = control.where(blank).withColumn("error", F.lit("no SQL query"))
    if failed:
        rejected = rejected.unionByName(spark.createDataFrame(failed, rejected.schema))
    schema = control.select(*control.columns, F.lit("").alias("query_id")).schema
    ran = spark.createDataFrame(marked, schema)
    return (reduce(DataFrame.unionByName, results) if results else None), rejected, ran


@dataclass(frozen=True)
class QueryOutcome:
    """What became of one control row: its place among the results, or why it has none."""

    row: Row
    query_id: str | None
    rows: int
    error: str | None
    retryable: bool

    @property
    def folder(self) -> str:
        return f"query_id={self.query_id}"


def run_each(
    spark: SparkSession, control: DataFrame, into: str, sql: str = "sql", args: list[str] | None = None, keep: list[str] | None = None, at_once: int = 4, tag: str | None = None
) -> Iterator[QueryOutcome]:
    """Run the query of each control row as jobs of its own, and write each result to a folder of ``into``.

    At most ``at_once`` queries are under way, all under the job tag ``tag`` (``spark.interruptTag`` ends them). A result is
    staged and moved into ``into/query_id=<id>`` when it is whole, so a query that fails, at whatever row, leaves nothing there and
    fails alone: its outcome has the error and whether another try may help. Results keep their own columns; those of one shape
    are read together with ``read_results``. Outcomes come in the order the queries end; no more than ``at_once`` rows of the control frame
    are held. A row without a query is refused without a job.
    """
    per_row, tag = sql in control.columns, tag or f"queries-{uuid.uuid4().hex}"
    for name in [*(args or []), *(keep or [])]:
        if name not in control.columns:
            raise QueryError(f"the control frame has no column '{name}'")
    types = {f.name: f.dataType for f in control.schema}

    def one(row: Row) -> QueryOutcome:
        files, query_id = Storage(spark), uuid.uuid4().hex
        staged = f"{into}/_staging/{query_id}"
        spark.addTag(tag)
        try:
            result = run_query(spark, row[sql] if per_row else sql, {a: row[a] for a in args or []})
            tags = [F.lit(row[k]).cast(types[k]).alias(k) for k in keep or []]
            seen = Observation()
            whole = result.select(*tags, *[F.col(f"`{c}`") for c in result.columns]).observe(seen, F.count(F.lit(1)).alias("rows"))
            whole.write.parquet(staged)
            files.move(staged, f"{into}/query_id={query_id}")
            return QueryOutcome(row, query_id, seen.get["rows"], None, False)
        except Exception as error:  # noqa: BLE001  the row's own failure; the others go on
            files.delete(staged)
            return QueryOutcome(row, None, 0, str(error).split("\n")[0][:1000], retryable_chain(cause_chain(error)))
        finally:
            spark.removeTag(tag)

    under_way: set[Future] = set()
    with ThreadPoolExecutor(at_once) as pool:
        for row in control.toLocalIterator():
            if len(under_way) >= at_once:
                done, under_way = wait(under_way, return_when=FIRST_COMPLETED)
                yield from (d.result() for d in done)
            under_way.add(pool.submit(inheritable_thread_target(spark)(one), row))
        while under_way:
            done, under_way = wait(under_way, return_when=FIRST_COMPLETED)
            yield from (d.result() for d in done)
    Storage(spark).delete_if_empty(f"{into}/_staging")


def read_results(spark: SparkSession, into: str) -> DataFrame | None:
    """The results that ``run_each`` wrote to a folder, with their ``query_id``; None when no query gave any."""
    if any(c.startswith("query_id=") for c in Storage(spark).children(into)):
        return spark.read.option("mergeSchema", True).parquet(into)
    return None


def outcomes(spark: SparkSession, control: DataFrame, found: list[QueryOutcome]) -> DataFrame:
    """The control rows with what became of each: ``query_id``, ``rows``, ``error`` and ``retryable``."""
    schema = control.select(*control.columns, F.lit("").alias("query_id"), F.lit(0).cast("bigint").alias("rows"), F.lit("").alias("error"), F.lit(True).alias("retryable")).schema
    for f in schema:
        f.nullable = True
    return spark.createDataFrame([(*o.row, o.query_id, o.rows, o.error, o.retryable) for o in found], schema)


def run_per_key(source: DataFrame, control: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    """The rows of ``source`` for every key of the control frame, with the control columns ``keep`` beside them."""
    return source.join(control.select(key, *(keep or [])), key)
