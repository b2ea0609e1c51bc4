"""Cut loads into batches of bounded size, each with a token that is the same on every replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.index import with_group_index, with_row_index
from quayside.plans.session import Scratch

MAX_ROWS = 100_000


def batch_token(base: Column, index: Column) -> Column:
    """``t`` for the first batch of a load, ``t-1``, ``t-2`` ... for the next; null without a base."""
    return F.when(index == 0, base).otherwise(F.concat(base, F.lit("-"), index.cast("string")))


def base_token(token: str, load_id: str = "load_id") -> Column:
    """The token of a load: ``"none"``, ``"load_id"`` or the name of a column that carries it."""
    if token == "none":
        return F.lit(None).cast("string")
    return F.col(f"`{load_id if token == 'load_id' else token}`").cast("string")


def token_error(token: str, load_id: str = "load_id", shown: str | None = None) -> Column:
    """Why a load has no usable token, null when it has one."""
    if token == "none":
        return F.lit(None).cast("string")
    name = shown or (load_id if token == "load_id" else token)
    value = base_token(token, load_id)
    missing = value.isNull() | value.rlike(r"^\s*$")
    return F.when(missing, F.lit(f"token column '{name}' is missing or empty"))


def cut_batches(
    df: DataFrame,
    order_by: list[str | Column] | None,
    max_rows: int = MAX_ROWS,
    load_id: str | None = None,
    token: str = "none",
    unique: bool = False,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Add ``batch_index`` (and ``batch_token`` unless ``token="none"``).

    Each load gets exactly ceil(rows / ``max_rows``) batches of consecutive rows in
    ``order_by`` order. Without ``load_id`` the DataFrame is one load; only then
    ``order_by`` may be None, which keeps the reading order and shuffles nothing.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be at least 1")
    if load_id is None:
        indexed = with_row_index(df, order_by, "_row", unique, scratch=scratch)
    elif order_by is None:
        raise ValueError("order_by is needed to cut several loads")
    else:
        indexed = with_group_index(df, [load_id], order_by, "_row", unique, scratch)
    cut = indexed.withColumn("batch_index", F.floor(F.col("_row") / F.lit(max_rows)).cast("bigint")).drop("_row")
    if token == "none":
        return cut
    return cut.withColumn("batch_token", batch_token(base_token(token, load_id or "load_id"), F.col("batch_index")))
