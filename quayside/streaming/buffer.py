"""Small units of a stream gathered until there are enough rows or they are old enough, then loaded as one."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.plans.storage import Storage


class Pending:
    """Units written under ``root`` and not yet loaded, in the order of their numbers.

    Every step can be run again after a crash: a unit counts once its note is there; ``plan.json`` names the units of a load
    before it begins, so that the load is repeated under the same id and with the same rows; ``done.json`` holds the last number
    loaded, and units up to it are cleared. A unit that comes again under a number already noted or loaded is left out.
    """

    def __init__(self, spark: SparkSession, root: str, rows: int, age: float, write: Callable[[DataFrame, str], None], clock: Callable[[], float] = time.time) -> None:
        self._spark, self._root, self._rows, self._age, self._write, self._clock = spark, root.rstrip("/"), rows, age, write, clock
        self._files = Storage(spark)
        self._lock = threading.RLock()
        self.error: BaseException | None = None

    def _note(self, name: str) -> dict | None:
        text = self._files.read_text(f"{self._root}/{name}.json")
        return json.loads(text) if text else None

    def done(self) -> int:
        """The last number that has been loaded, -1 for none."""
        return (self._note("done") or {"last": -1})["last"]

    def units(self) -> list[dict]:
        """Notes of the units that wait: ``number``, ``rows`` and when they came (``at``, seconds)."""
        done = self.done()
        numbers = sorted(int(n[5:-5]) for n in self._files.children(self._root) if n.startswith("unit-") and n.endswith(".json"))
        return [self._note(f"unit-{n}") for n in numbers if n > done]

    def add(self, df: DataFrame, number: int) -> None:
        """Write a unit down, then load what waits if it is due."""
        with self._lock:
            if self.error:
                raise self.error
            self._finish()
            if number > self.done() and self._note(f"unit-{number}") is None:
                folder = f"{self._root}/rows-{number}"
                df.write.mode("overwrite").parquet(folder)
                n = self._spark.read.schema(df.schema).parquet(folder).count()
                self._files.write_text(f"{self._root}/unit-{number}.json", json.dumps({"number": number, "rows": n, "at": self._clock(), "schema": df.schema.json()}))
            self.flush_due()

    def flush_due(self) -> bool:
        """Load what waits when it has enough rows or its oldest unit is old enough; whether it did."""
        with self._lock:
            waiting = self.units()
            due = waiting and (sum(u["rows"] for u in waiting) >= self._rows or self._clock() - waiting[0]["at"] >= self._age)
            return bool(due) and self.flush()

    def flush(self) -> bool:
        """Load what waits, whatever its size; whether anything did."""
        with self._lock:
            self._finish()
            waiting = self.units()
            if not waiting:
                return False
            self._files.write_text(f"{self._root}/plan.json", json.dumps({"units": waiting}))
            self._finish()
            return True

    def _finish(self) -> None:
        """Load the units of the plan, if there is one, note them as loaded, and clear them."""
        plan = self._note("plan")
        if plan is None:
            return
        first, last = plan["units"][0]["number"], plan["units"][-1]["number"]
        if last > self.done():
            from pyspark.sql.types import StructType

            rows = None  # a frame per schema: a source may gain columns between two units
            for schema in dict.fromkeys(u["schema"] for u in plan["units"]):
                paths = [f"{self._root}/rows-{u['number']}" for u in plan["units"] if u["schema"] == schema]
                some = self._spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*paths)
                rows = some if rows is None else rows.unionByName(some, allowMissingColumns=True)
            self._write(rows, f"{first}-{last}")
            self._files.write_text(f"{self._root}/done.json", json.dumps({"last": last}))
        for u in plan["units"]:
            self._files.delete(f"{self._root}/unit-{u['number']}.json")
            self._files.delete(f"{self._root}/rows-{u['number']}")
        self._files.delete(f"{self._root}/plan.json")

    def watch(self, query, every: float) -> threading.Thread:
        """A thread that loads what grows old while no rows come; it ends with the query. Its error stops the next unit."""

        def run() -> None:
            try:
                while not query.awaitTermination(max(every, 0.1)):
                    self.flush_due()
            except Exception as error:  # noqa: BLE001
                if query.isActive:
                    self.error = error

        thread = threading.Thread(target=run, daemon=True)
        thread.start()
        return thread
