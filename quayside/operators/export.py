"""Results out: any file format, exact-size fragments, a manifest, all or nothing."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.functions.jsontext import json_object
from quayside.functions.normalize import normalize
from quayside.operators.index import with_row_index
from quayside.plans.session import Scratch
from quayside.plans.storage import Storage
from quayside.types import ColumnSpec

FRAGMENT = "fragment_index"


@dataclass
class ExportResult:
    identifier: str
    fragments: int
    rows: int
    manifest: DataFrame


def with_fragments(df: DataFrame, max_rows: int, order_by: list[str | Column] | None = None, unique: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Add ``row_index`` and ``fragment_index``: consecutive runs of ``max_rows`` rows.

    Without ``order_by`` the order is the one the frame has, e.g. from its ORDER BY.
    """
    indexed = with_row_index(df, order_by, "row_index", unique, scratch=scratch)
    return indexed.withColumn(FRAGMENT, F.floor(F.col("row_index") / F.lit(max_rows)).cast("bigint"))


def manifest_of(spark: SparkSession, rows: int, max_rows: int, identifier: str, fmt: str) -> DataFrame:
    """One row per fragment of ``rows`` rows; an empty result has one fragment of no rows.

    Fragments are full but for the last, so the total tells all of it and nothing is read. With ``max_rows=0`` nothing was
    split and the fragment columns are null.
    """
    if max_rows == 0:
        return spark.range(1).select(
            F.lit(None).cast("string").alias("fragment_identifier"), F.lit(None).cast("bigint").alias(FRAGMENT), F.lit(None).cast("bigint").alias("fragment_count"),
            F.lit(rows).cast("bigint").alias("record_count"), F.lit(fmt).alias("format"),
        )
    n = max(-(-rows // max_rows), 1)
    size = F.least(F.lit(max_rows).cast("bigint"), F.lit(rows).cast("bigint") - F.col("id") * max_rows)
    return spark.range(n).select(
        F.lit(identifier).alias("fragment_identifier"), F.col("id").alias(FRAGMENT), F.lit(n).cast("bigint").alias("fragment_count"), size.alias("record_count"), F.lit(fmt).alias("format")
    )


def export(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    max_rows: int = 0,
    columns: list[ColumnSpec] | None = None,
    order_by: list[str | Column] | None = None,
    unique: bool = False,
    in_place: bool = False,
    **options,
) -> ExportResult:
    """Write a result under ``path`` and say what was written.

    ``max_rows=0`` writes one output. Otherwise each ``fragment_index=<i>`` folder
    holds one file of at most ``max_rows`` rows in result order. ``json`` writes one
    exact object per line. Everything is written beside ``path`` first and moved there
    when complete: a failed query leaves nothing behind. Where moving a folder means copying it (object stores), ``in_place``
    writes to ``path`` itself and puts a manifest beside the data last; ``read_export`` only takes what has one.
    """
    if max_rows < 0:
        raise ValueError("max_rows must not be negative")
    spark, files, scratch = df.sparkSession, Storage(df.sparkSession), Scratch(df.sparkSession)
    if files.exists(path):
        raise FileExistsError(f"{path} already exists")
    identifier = uuid.uuid4().hex
    staging = path.rstrip("/") if in_place else f"{path.rstrip('/')}__writing-{identifier}"
    records = normalize(df, columns)
    try:
        if max_rows == 0:
            seen = Observation()
            _write(records.observe(seen, F.count(F.lit(1)).alias("rows")), staging, fmt, options)
            rows, fragments = seen.get["rows"], 1
        else:
            cut = with_fragments(records, max_rows, order_by, unique, scratch)
            rows = (cut.agg(F.max("row_index")).first()[0] or 0) + 1 if not cut.isEmpty() else 0
            fragments = max(-(-rows // max_rows), 1)
            if rows:
                # one task per fragment keeps it in one file, in order
                placed = cut.repartitionById(fragments, F.col(FRAGMENT).cast("int")).sortWithinPartitions("row_index").drop("row_index")
                _write(placed, staging, fmt, options, FRAGMENT)
            else:
                _write(records, f"{staging}/{FRAGMENT}=0", fmt, options)
        if in_place:
            told = {"fragment_identifier": identifier, "fragments": fragments, "rows": rows, "format": fmt}
            files.put_new(f"{staging}/{MANIFEST}", json.dumps(told))
        else:
            files.move(staging, path)
    except BaseException:
        files.delete(staging)
        raise
    finally:
        scratch.clear()
    return ExportResult(identifier, fragments, rows, manifest_of(spark, rows, max_rows, identifier, fmt))


MANIFEST = "_manifest.json"


def read_export(spark: SparkSession, path: str, **options) -> DataFrame:
    """The rows of an export that was written in place; one without its manifest, not ended or failed, does not exist."""
    text = Storage(spark).read_text(f"{path.rstrip('/')}/{MANIFEST}")
    if text is None:
        raise FileNotFoundError(f"{path} holds no finished export")
    return spark.read.options(**options).format(json.loads(text)["format"]).load(path)


def _write(records: DataFrame, path: str, fmt: str, options: dict, partition: str | None = None) -> None:
    by = [partition] if partition else []
    if fmt == "json":
        fields = [c for c in records.columns if c not in by]
        text = records.select(json_object(records, fields).alias("value"), *by)
        text.write.options(**options).partitionBy(*by).text(path)
        return
    if fmt == "csv":
        options = {"header": True, **options}
    records.write.format(fmt).options(**options).partitionBy(*by).save(path)
