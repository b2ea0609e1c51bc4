"""Statements over Parquet tables: create, insert-select, delete, update, compact, archive, with a summary.

Parquet tables refuse DELETE and UPDATE, so those rewrite. Only the folders that hold
matching rows are rewritten (a partition each, or the whole table when it has none);
the new files are written aside and counted before the folders are exchanged. The old
folders go only when the new ones can be read in their place; what a lost driver left
half done is undone by the next statement on the table. One writer per table.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.operators.index import range_sorted
from quayside.plans.session import Scratch
from quayside.plans.storage import Storage
from quayside.sources.readers import TYPES_PROPERTY, table_spec
from quayside.types import ColumnSpec, storage_type


class StatementError(RuntimeError):
    """A statement was refused or its result did not add up."""


@dataclass
class Summary:
    """What a statement did. Counts that do not apply are 0."""

    read_rows: int = 0
    read_bytes: int = 0
    written_rows: int = 0
    written_bytes: int = 0
    result_rows: int = 0
    result_bytes: int = 0
    elapsed_ns: int = 0

    def flat(self) -> dict[str, str]:
        return {f"summary.{k}": str(v) for k, v in self.__dict__.items()}


class _Clock:
    def __enter__(self) -> Summary:
        self._start, self.summary = time.perf_counter_ns(), Summary()
        return self.summary

    def __exit__(self, *_) -> None:
        self.summary.elapsed_ns = time.perf_counter_ns() - self._start


def _require(sql: str | None) -> str:
    if sql is None or not sql.strip():
        raise StatementError("no SQL statement")
    return sql


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": table}).where("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def run(spark: SparkSession, sql: str, args: dict | None = None) -> Summary:
    """Run one statement with bound arguments. The rows of a SELECT are counted and thrown away."""
    with _Clock() as summary:
        result = spark.sql(_require(sql), args=args or {})
        if result.columns:
            # a row's bytes as it would be sent, one JSON object
            once = len(set(result.columns)) == len(result.columns)
            size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in result.columns]))) if once else F.lit(0)
            counted = result.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))
            summary.result_rows, summary.result_bytes = counted.collect()[0]
            _take_read(summary, counted)
    return summary


def _nodes(plan):
    """The nodes of a plan as it ran, each once."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        inner = {"AdaptiveSparkPlanExec": "executedPlan", "CommandResultExec": "commandPhysicalPlan"}.get(name, "plan" if name.endswith("QueryStageExec") else None)
        if inner:
            waiting.append(getattr(node, inner)())
            continue
        yield node
        for some in (node.children(), node.subqueries()):
            each = some.iterator()
            while each.hasNext():
                waiting.append(each.next())


def _take_read(summary: Summary, ran: DataFrame) -> None:
    """Rows and bytes that the scans of a finished plan read: rows of files after the filters a format applies itself."""
    for node in _nodes(ran._jdf.queryExecution().executedPlan()):
        metrics = node.metrics()
        if node.getClass().getSimpleName().endswith("ScanExec") or "Scan" in node.nodeName():
            for name, field in (("numOutputRows", "read_rows"), ("filesSize", "read_bytes")):
                if metrics.contains(name):
                    setattr(summary, field, getattr(summary, field) + metrics.apply(name).value())


def create_table(
    spark: SparkSession,
    table: str,
    columns: list[ColumnSpec],
    if_not_exists: bool = False,
    partition_by: list[str] | None = None,
    path: str | None = None,
) -> Summary:
    """Create a Parquet table for the columns, with their defaults; ``table_spec`` reads the exact types back."""
    parts = []
    for s in columns:
        default = f" DEFAULT {s.default}" if s.default else ""
        parts.append(f"`{s.name}` {storage_type(s.type).simpleString()}{default}")
    described = json.dumps([{"name": s.name, "type": s.type_text, "computed": s.computed} for s in columns])
    sql = f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}IDENTIFIER(:t) ({', '.join(parts)}) USING parquet"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if path:
        sql += " LOCATION '" + path.replace("'", "\\'") + "'"
    quoted = described.replace("\\", "\\\\").replace("'", "\\'")
    return run(spark, f"{sql} TBLPROPERTIES ('{TYPES_PROPERTY}' = '{quoted}')", {"t": table})


def insert_select(spark: SparkSession, table: str, select: str, args: dict | None = None) -> Summary:
    """Append the rows of a SELECT; columns it does not have take their defaults. Columns match by name."""
    files, at = Storage(spark), location(spark, table)
    with _Clock() as summary:
        before = files.size(at)
        rows = spark.sql(_require(select), args=args or {})
        _append(spark, table, rows, summary)
        summary.written_bytes = files.size(at) - before
    return summary


def _append(spark: SparkSession, table: str, rows: DataFrame, summary: Summary) -> None:
    seen = Observation()
    view = f"_rows_{uuid.uuid4().hex}"
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).createOrReplaceTempView(view)
    names = ", ".join(f"`{c}`" for c in rows.columns)
    try:
        ran = spark.sql(f"INSERT INTO IDENTIFIER(:t) ({names}) SELECT {names} FROM {view}", args={"t": table})
    finally:
        spark.catalog.dropTempView(view)
    summary.written_rows = seen.get["rows"]
    _take_read(summary, ran)


def _folders(matching: DataFrame) -> list[str]:
    """The folders that hold rows of a table scan, at most one per partition of the table."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]+$", "")
    return sorted(unquote(r[0]) for r in matching.select(folder).distinct().collect())


def _plain(path: str) -> str:
    """A local path without its scheme, which Spark spells in several ways."""
    return path.removeprefix("file:").replace("///", "/")


_BEFORE, _DONE = "__before-", "__done-"


def recover_table(spark: SparkSession, table: str) -> None:
    """Undo an exchange that a lost driver left half done, and remove what a finished one left."""
    files, at = Storage(spark), location(spark, table)
    parent, _, name = at.rpartition("/")
    for sibling in files.children(parent):
        if sibling.startswith(f"{name}{_DONE}"):
            files.delete(f"{parent}/{sibling}")
        elif sibling.startswith(f"{name}{_BEFORE}"):
            aside = f"{parent}/{sibling}"
            for part in files.children(f"{aside}/_parts"):
                _restore(files, at, aside, unquote(part.removeprefix("part=")))
            files.delete(aside)
            spark.catalog.refreshTable(table)


def _restore(files: Storage, at: str, aside: str, part: str) -> None:
    """Put one old folder back, if it was moved."""
    live, old = f"{at}/{part}".rstrip("/"), f"{aside}/old/{part}".rstrip("/")
    if files.exists(old):
        files.delete(live)
        files.move(old, live)


def _exchange(spark: SparkSession, table: str, at: str, staged: str, folders: list[str], rows: int, schema) -> None:
    """Put staged folders in the place of live ones and read them there; on an error put the old ones back."""
    files, call = Storage(spark), uuid.uuid4().hex
    aside, root = f"{at}{_BEFORE}{call}", _plain(at)
    parts = [_plain(folder).removeprefix(root).strip("/") for folder in folders]
    for part in parts:  # what recover_table has to look at
        files.make_dirs(f"{aside}/_parts/part={quote(part, safe='')}")
    gone = False
    try:
        for part in parts:
            live, old, new = (f"{p}/{part}".rstrip("/") for p in (at, f"{aside}/old", staged))
            files.move(live, old)
            if files.exists(new):
                files.move(new, live)
            elif not part:
                files.make_dirs(live)
            else:
                gone = True
        places = [p for p in (f"{at}/{part}".rstrip("/") for part in parts) if files.exists(p)]
        readable = spark.read.schema(schema).option("basePath", at).parquet(*places).count() if places else 0
        if readable != rows:
            raise StatementError(f"{readable} rows of {table} could be read in place of {rows}; nothing was changed")
    except BaseException:
        for part in parts:
            _restore(files, at, aside, part)
        files.delete(aside)
        raise
    files.move(aside, f"{at}{_DONE}{call}")
    files.delete(f"{at}{_DONE}{call}")
    if gone:
        spark.sql("MSCK REPAIR TABLE IDENTIFIER(:t) SYNC PARTITIONS", args={"t": table})
    spark.catalog.refreshTable(table)


def _refuse_random(rows: DataFrame, predicate: Column) -> None:
    """A predicate that differs from one reading to the next would delete other rows than it counted."""
    if not rows.where(predicate)._jdf.queryExecution().analyzed().deterministic():
        raise StatementError("the predicate is not deterministic")


def _rewrite(spark: SparkSession, table: str, matching: Column, change, gone: bool, before_exchange=None) -> Summary:
    """Rewrite the folders with matching rows through ``change``; ``gone`` tells whether matching rows disappear.

    The predicate is evaluated once per row, into a column of a copy; all counts and both sides come from that copy.
    ``before_exchange`` gets the matching rows before anything is changed.
    """
    recover_table(spark, table)
    files, scratch, at = Storage(spark), Scratch(spark), location(spark, table)
    parts = partition_columns(spark, table)
    with _Clock() as summary:
        live = spark.table(table)
        _refuse_random(live, matching)
        hit = F.coalesce(matching, F.lit(False))
        try:
            if parts:
                folders = _folders(live.where(matching))
                # only the touched folders are read, only they are written
                rows = spark.read.schema(live.schema).option("basePath", at).parquet(*folders).select(*live.columns) if folders else None
            else:
                folders, rows = [at], live
            if rows is None:
                return summary
            marked = scratch.keep(rows.withColumn(_HIT, hit), "marked") if before_exchange else rows.withColumn(_HIT, hit)
            seen = Observation()
            counted = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(_HIT), 1)).alias("hits"))
            staged = scratch.path("rewrite")
            change(counted, F.col(_HIT)).drop(_HIT).write.partitionBy(*parts).parquet(staged)
            before, hits = seen.get["rows"], seen.get["hits"]
            if not hits:
                return summary
            after = spark.read.schema(live.schema).option("basePath", staged).parquet(staged).count()
            if after != before - (hits if gone else 0):
                raise StatementError(f"rewriting {table} gave {after} rows out of {before} with {hits} matching; nothing was changed")
            summary.read_rows, summary.written_rows, summary.result_rows = before, after, hits
            summary.written_bytes = files.size(staged)
            if before_exchange:
                before_exchange(marked.where(F.col(_HIT)).drop(_HIT))
            _exchange(spark, table, at, staged, folders, after, live.schema)
        finally:
            scratch.clear()
    return summary


_HIT = "__hit"


def delete_where(spark: SparkSession, table: str, predicate: str) -> Summary:
    """Delete the rows for which ``predicate`` is true; ``result_rows`` says how many."""
    return _rewrite(spark, table, F.expr(_require(predicate)), lambda rows, hit: rows.where(~hit), gone=True)


def update_where(spark: SparkSession, table: str, predicate: str, assignments: dict[str, str]) -> Summary:
    """Set columns to expressions over the old row where ``predicate`` is true."""
    types = {f.name: f.dataType for f in spark.table(table).schema.fields}
    fixed = set(partition_columns(spark, table))
    for name in assignments:
        if name not in types:
            raise StatementError(f"table {table} has no column '{name}'")
        if name in fixed:
            raise StatementError(f"column '{name}' partitions the table and cannot be updated in place")

    def change(rows: DataFrame, hit: Column) -> DataFrame:
        return rows.select(
            *[
                F.when(hit, F.expr(assignments[n]).cast(t)).otherwise(F.col(f"`{n}`")).alias(n) if n in assignments else F.col(f"`{n}`")
                for n, t in types.items()
            ]
        )

    return _rewrite(spark, table, F.expr(_require(predicate)), change, gone=False)


def compact(spark: SparkSession, table: str, order_by: list[str], files: int) -> Summary:
    """Rewrite every folder of a table as ``files`` files or fewer, ordered by ``order_by`` throughout."""
    parts = partition_columns(spark, table)

    def change(rows: DataFrame, _: Column) -> DataFrame:
        return range_sorted(rows, [*parts, *order_by], partitions=files)

    return _rewrite(spark, table, F.lit(True), change, gone=False)


def archive_move(spark: SparkSession, source: str, target: str, predicate: str) -> Summary:
    """Move matching rows from one table to another: insert them, check the count, delete them.

    Which rows match is settled once, in a copy of the touched folders, so ``now()`` means one moment. Stopped in
    between, the rows are in both tables, never in none.
    """
    moved = Summary()

    def insert(rows: DataFrame) -> None:
        _append(spark, target, rows, moved)

    with _Clock() as summary:
        deleted = _rewrite(spark, source, F.expr(_require(predicate)), lambda rows, hit: rows.where(~hit), gone=True, before_exchange=insert)
        if deleted.result_rows != moved.written_rows:
            raise StatementError(f"{moved.written_rows} rows were archived but {deleted.result_rows} deleted")
        summary.read_rows, summary.written_rows, summary.result_rows = deleted.read_rows, moved.written_rows, deleted.result_rows
    return summary


def add_columns(spark: SparkSession, table: str, columns: list[ColumnSpec]) -> Summary:
    """ALTER TABLE ADD COLUMNS; rows already there read as null in the new ones, later ones take the columns' defaults."""
    known = [{"name": s.name, "type": s.type_text, "computed": s.computed} for s in [*table_spec(spark, table), *columns]]
    added = ", ".join(f"`{s.name}` {storage_type(s.type).simpleString()}" for s in columns)
    summary = run(spark, f"ALTER TABLE IDENTIFIER(:t) ADD COLUMNS ({added})", {"t": table})
    for s in columns:
        if s.default:
            spark.sql(f"ALTER TABLE IDENTIFIER(:t) ALTER COLUMN `{s.name}` SET DEFAULT {s.default}", args={"t": table})
    quoted = json.dumps(known).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET TBLPROPERTIES ('{TYPES_PROPERTY}' = '{quoted}')", args={"t": table})
    return summary


def truncate(spark: SparkSession, table: str) -> Summary:
    """Remove all rows. Spark's TRUNCATE refuses tables with a location of their own, so this overwrites with nothing."""
    with _Clock() as summary:
        nothing = spark.createDataFrame([], spark.table(table).schema)
        nothing.write.option("partitionOverwriteMode", "static").insertInto(table, overwrite=True)
        spark.catalog.refreshTable(table)
    return summary


def drop(spark: SparkSession, table: str) -> Summary:
    return run(spark, "DROP TABLE IF EXISTS IDENTIFIER(:t)", {"t": table})
