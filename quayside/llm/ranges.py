"""Rows dealt by ranges of their id, so that consecutive ids meet in one task and files follow the order of ids."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET = "__bucket"


def wanted_buckets(df: DataFrame, id_col: str) -> int:
    """As many ranges as the input has splits, or the session's shuffle partitions if those are more."""
    return max(df.select(id_col).rdd.getNumPartitions(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_bucket(df: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """``df`` with ``__bucket``: 0 to about ``buckets`` - 1, ascending with the id, of like size; null ids are in 0.

    The bounds are quantiles of the ids fixed here as literals, so a task that is run again deals its rows alike.
    """
    bounds: list[float] = []
    if buckets > 1:
        found = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("double").alias("v")).approxQuantile("v", [k / buckets for k in range(1, buckets)], 0.1 / buckets)
        bounds = sorted(set(found))
    place = Bucketizer(splits=[-math.inf, *bounds, 0.0 if not bounds else math.inf, *([math.inf] if not bounds else [])], inputCol="__id", outputCol=BUCKET)
    placed = place.transform(df.withColumn("__id", F.coalesce(F.col(id_col).cast("double"), F.lit(-1e300))))
    return placed.withColumn(BUCKET, F.col(BUCKET).cast("int")).drop("__id")


def dealt(df: DataFrame, buckets: int) -> DataFrame:
    """Rows with a ``__bucket``, one task per bucket."""
    return df.repartitionById(buckets, F.col(BUCKET))
