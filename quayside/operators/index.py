"""Exact row numbers over a whole DataFrame or inside its groups, without one big sort task.

``row_number()`` over an unpartitioned window runs in a single task. Here every
range partition is numbered on its own; the partition sizes, one number per
partition, turn into offsets that are broadcast back.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.plans.session import Scratch, hinted

# monotonically_increasing_id: partition number in the upper bits, position in the lower 33.
_POSITION_BITS = 33


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype)
    return isinstance(dtype, (T.MapType, T.VariantType))


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash over all columns of a row."""
    parts = [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if _has_map(f.dataType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return F.xxhash64(*parts)


def _columns(order_by: list[str | Column]) -> list[Column]:
    return [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by]


def range_sorted(df: DataFrame, order_by: list[str | Column], unique: bool = False, partitions: int | None = None) -> DataFrame:
    """Rows in global order of ``order_by``: partition after partition, sorted inside each.

    Unless the order is declared ``unique``, ties are spread too: first by a hash of
    the row, then, for equal copies of a row, by their number in their input
    partition. So neither a hot key nor a hot group of copies ends in one task. The
    copy number comes after a local sort by content, hence a repeated task numbers
    the same copies the same way.
    """
    keys = _columns(order_by)
    ties: list[str] = []
    if not unique:
        plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
        df = df.withColumn("_hash", row_hash(df)).sortWithinPartitions("_hash", *plain)
        df = df.withColumn("_copy", F.monotonically_increasing_id())
        ties = ["_hash", "_copy"]
    keys = [*keys, *[F.col(t) for t in ties]]
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys).drop(*ties)


def with_row_index(
    df: DataFrame,
    order_by: list[str | Column] | None = None,
    name: str = "row_index",
    unique: bool = False,
    partitions: int | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Add the 0-based position of every row in the order of ``order_by``.

    Without ``order_by`` the rows keep the order they have (reading order, or the
    order of an ``ORDER BY``) and nothing is shuffled. The numbered rows are written
    once to the shared scratch folder, so a lost executor cannot change them.
    """
    scratch = scratch or Scratch(df.sparkSession)
    ordered = range_sorted(df, order_by, unique, partitions) if order_by else df
    kept = scratch.keep(ordered.withColumn("_at", F.monotonically_increasing_id()), "indexed")
    bucket = F.shiftright("_at", _POSITION_BITS)
    # one number per partition of the write, as small as Spark's own task list
    sizes = sorted(kept.groupBy(bucket.alias("bucket")).count().collect())
    starts = accumulate((n for _, n in sizes), initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(b, s) for (b, _), s in zip(sizes, starts, strict=False)], "_bucket bigint, _offset bigint"
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    numbered = kept.withColumn("_bucket", bucket).join(hinted(offsets, len(sizes)), "_bucket")
    return numbered.withColumn(name, F.col("_offset") + position).drop("_bucket", "_offset", "_at")


def with_group_index(
    df: DataFrame, group: list[str], order_by: list[str | Column], name: str = "row_index", unique: bool = False, scratch: Scratch | None = None
) -> DataFrame:
    """Add the 0-based position of every row inside its group.

    All rows are numbered in the order of (group, ``order_by``) by the range method, and each group's first number is
    subtracted. So a group of any size is spread over as many tasks as its rows need; there is one shuffle of the rows.
    """
    numbered = with_row_index(df, [*group, *order_by], "_global", unique, scratch=scratch)
    renamed = [F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(group)]
    starts = numbered.groupBy(*renamed).agg(F.min("_global").alias("_start"))
    starts = hinted(starts, starts.count())
    match = F.lit(True)
    for i, g in enumerate(group):
        match = match & numbered[f"`{g}`"].eqNullSafe(starts[f"_g{i}"])
    placed = numbered.join(starts, match).withColumn(name, F.col("_global") - F.col("_start"))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], name)
