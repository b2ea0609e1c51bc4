"""Split converted rows into accepted and rejected ones, by row, by load or by batch prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.convert import ERRORS

UNITS = ("row", "load", "prefix")


def is_bad(errors: str = ERRORS) -> Column:
    return F.size(F.col(errors)) > 0


def route(df: DataFrame, unit: str = "load", load_id: str = "load_id", batch: str = "batch_index", errors: str = ERRORS) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected).

    ``row``: each row on its own. ``load``: one bad row keeps its whole load out.
    ``prefix``: the batches of a load before its first bad batch are accepted, the
    rest is rejected. Only bad rows feed the group-by, and the join leaves a hot
    load to Spark's skew-join handling.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    if unit == "row":
        return df.where(~is_bad(errors)), df.where(is_bad(errors))
    bad = df.where(is_bad(errors))
    if unit == "load":
        failed = bad.select(F.col(load_id).alias("_failed")).distinct()
        same = df[load_id].eqNullSafe(failed["_failed"])
        return df.join(failed, same, "left_anti"), df.join(failed, same, "left_semi")
    first = bad.groupBy(F.col(load_id).alias("_failed")).agg(F.min(batch).alias("_first_bad"))
    joined = df.join(first, df[load_id].eqNullSafe(first["_failed"]), "left")
    late = F.coalesce(F.col(batch) >= F.col("_first_bad"), F.lit(False))
    return joined.where(~late).select(df.columns), joined.where(late).select(df.columns)
