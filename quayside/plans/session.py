"""Session facts the operators rely on: where scratch tables go, and what may be broadcast."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table known to have at most this many narrow rows may be broadcast (a few ten MB).
BROADCAST_ROWS = 200_000


def configure(spark: SparkSession) -> SparkSession:
    """Settings the library needs: UTC instants. Spark's adaptive execution stays as it is (on by default)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="quayside-")
    return _local_root


class Scratch:
    """Tables written once in the shared folder, so that later stages read fixed rows instead of recomputing them.

    Whoever makes one clears it; what is left is cleared when the driver's Python ends, so a lazy result can still be read
    until then.
    """

    _left: dict[str, Scratch] = {}

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{scratch_root(spark)}/quayside-{uuid.uuid4().hex}"
        self._count = 0
        Scratch._left[self.root] = self

    def path(self, label: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{label}"

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and read it back."""
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Remove everything kept. Frames read from here are gone afterwards."""
        from quayside.plans.storage import Storage

        Storage(self.spark).delete(self.root)
        Scratch._left.pop(self.root, None)


@atexit.register
def _clear_scratch() -> None:
    for scratch in list(Scratch._left.values()):
        try:
            scratch.clear()
        except Exception:  # noqa: BLE001  the session is gone, and with it the way to its file system
            return


def hinted(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint when its counted rows are few, else left to Spark's own choice."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
