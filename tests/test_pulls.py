"""The k-th key without one sort, marks in the log, retries, exports in place, statement figures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import ledger as L
from quayside.operators import statements as S
from quayside.operators.export import export, read_export
from quayside.operators.load import load
from quayside.operators.retry import due_loads, run_loads
from quayside.plans.storage import Storage
from quayside.sources import readers
from quayside.types import ColumnSpec, spec


@pytest.mark.parametrize("kind", ["bigint", "decimal(12,3)", "double", "date", "timestamp", "string", "hot"])
@pytest.mark.parametrize("ranges", [3, 1000])
def test_the_kth_key_by_counting(spark, monkeypatch, kind, ranges):
    monkeypatch.setattr(readers, "SORTED_KEYS", 5)
    monkeypatch.setattr(readers, "_RANGES", ranges)
    rng = random.Random(ranges)
    numbers = [rng.choice([rng.randrange(40), rng.randrange(10**6), 7]) for _ in range(300)] if kind != "hot" else [7] * 200 + list(range(100))
    keys = spark.createDataFrame([(n,) for n in numbers], "n bigint").repartition(4)
    cast = {"date": F.date_add(F.lit(dt.date(1990, 1, 1)), (F.col("n") % 9000).cast("int")), "timestamp": F.timestamp_micros("n"), "string": F.lpad(F.col("n").cast("string"), 8, "0")}
    keys = keys.select(cast.get(kind, F.col("n").cast("bigint" if kind == "hot" else kind)).alias("key"))
    ordered = [r["key"] for r in keys.orderBy("key").collect()]
    for k in (1, 5, 6, 100, 250, 299, 300, 1000):
        assert readers._kth_key(keys, "key", k) == ordered[min(k, 300) - 1], k
    assert readers._kth_key(keys.where("false"), "key", 10) is None


def test_marks_stay_in_the_log(spark, tmp_path):
    book = str(tmp_path / "book")
    assert readers.pulled_to(spark, book, "a", T.LongType()) is None
    for k in range(12):
        readers.note_pulled(spark, book, "a", spark.range(k, k + 3), "id")
        L.append_ledger([{"seq": k, "table": "t", "load_id": "l", "token": None, "batch_index": 0, "rows": 1, "status": L.ACCEPTED, "attempts": 1, "causes": []}], book, spark=spark)
    readers.note_pulled(spark, book, "a", spark.range(0), "id")
    assert readers.pulled_to(spark, book, "a", T.LongType()) == 13 and L.read_ledger(spark, book).count() == 12


def test_retries_end_and_are_handed_back(spark, tmp_path):
    path, book = str(tmp_path / "t"), str(tmp_path / "l")
    calls, error = [], TimeoutError("slow")

    def attempt(load_id):
        calls.append(load_id)
        if load_id == "never" or (load_id == "later" and calls.count("later") < 3):
            raise error
        if load_id == "bad":
            raise PermissionError("no")
        return load(spark.range(3).select("id"), path, spec(("id", "UInt8")), book, load_id=load_id, table="t")

    back = {r["load_id"]: (r["status"], r["attempts"], r["error"]) for r in run_loads(spark, book, "t", attempt, ["now", "later", "never", "bad"], 4, lambda _: 0).collect()}
    assert set(back) == {"never", "bad"} and back["never"][:2] == (L.RETRY, 4) and back["bad"][:2] == (L.FAILED, 1)
    assert {k: calls.count(k) for k in calls} == {"now": 1, "later": 3, "never": 4, "bad": 1}
    assert due_loads(spark, book, "t", 4).count() == 0 and due_loads(spark, book, "t", 5).count() == 1


def test_exports_in_place(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    assert export(spark.range(10), good, "json", max_rows=4, in_place=True).fragments == 3
    assert read_export(spark, good).count() == 10
    with pytest.raises(Exception, match="lost"):
        export(spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint").alias("id")), bad, in_place=True)
    assert not Storage(spark).exists(bad)
    with pytest.raises(FileNotFoundError):
        read_export(spark, bad)


def test_figures_of_statements(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "in"))
    view = "figures_in"
    spark.read.parquet(str(tmp_path / "in")).createOrReplaceTempView(view)
    read = S.run(spark, f"SELECT id, id AS again FROM {view} WHERE id % 10 = 0")
    assert (read.read_rows, read.result_rows) == (1000, 100) and read.read_bytes == sum(f.stat().st_size for f in (tmp_path / "in").glob("*.parquet"))
    assert read.result_bytes == sum(len(f'{{"id":{i},"again":{i}}}') for i in range(0, 1000, 10))
    S.create_table(spark, "figures_out", [ColumnSpec("id", "Int64")], path=str(tmp_path / "out"))
    put = S.insert_select(spark, "figures_out", f"SELECT id FROM {view} WHERE id % 10 = 0")
    assert (put.read_rows, put.written_rows) == (1000, 100) and put.written_bytes > 0 and put.read_bytes == read.read_bytes
    assert S.run(spark, "SELECT 1 AS x, 2 AS x").result_rows == 1
    S.drop(spark, "figures_out")
