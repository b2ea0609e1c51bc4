"""The load path end to end: replay, units, crash repair, edge cases."""

import pytest
from pyspark.sql import functions as F

from quayside.operators import ledger as L
from quayside.operators.align import AlignmentError
from quayside.operators.load import load, read_target
from quayside.plans.storage import Storage
from quayside.types import ColumnSpec, spec

BIG = spec(("id", "UInt64"), ("name", "String"), ("ts", "DateTime64(3, 'UTC')"), ("amount", "Decimal(18, 4)"))


def records(spark, n):
    i = F.col("id")
    return spark.range(1, n + 1).select(
        i.cast("string").alias("id"), F.concat(F.lit("name-"), i).alias("name"),
        F.concat(F.lit("2024-01-01T00:00:00."), F.lpad((i % 1000).cast("string"), 3, "0"), F.lit("Z")).alias("ts"),
        F.concat(i.cast("string"), F.lit(".2500")).alias("amount"),
    )


@pytest.fixture()
def where(tmp_path):
    return str(tmp_path / "big"), str(tmp_path / "ledger")


def rows(spark, path):
    return sorted(int(r["id"]) for r in read_target(spark, path).select("id").collect())


def test_one_load_and_its_replay(spark, where):
    path, book = where
    first = load(records(spark, 1000), path, BIG, book, load_id="load-42", max_rows=100)
    assert (first.rows_written, first.inserts, first.duplicate_inserts, first.rejected_rows) == (1000, 10, 0, 0)
    assert sorted(r["token"] for r in first.batches.collect()) == sorted(["load-42", *(f"load-42-{i}" for i in range(1, 10))])
    again = load(records(spark, 1000), path, BIG, book, load_id="load-42", max_rows=100)
    assert (again.rows_written, again.inserts, again.duplicate_inserts) == (1000, 10, 10)
    assert rows(spark, path) == list(range(1, 1001))
    seventh = read_target(spark, path, BIG).where("id = 7").first()
    assert seventh["ts"].microsecond == 7000 and str(seventh["amount"]) == "7.2500"
    first.close()
    again.close()


def test_empty_input_writes_nothing(spark, where):
    path, book = where
    done = load(records(spark, 0), path, BIG, book, load_id="none")
    assert (done.rows_written, done.inserts) == (0, 0)
    assert not Storage(spark).exists(book) and not [c for c in Storage(spark).children(path) if not c.startswith("_staging")]


def test_a_bad_row_keeps_its_load_out_and_says_why(spark, where):
    path, book = where
    bad = records(spark, 30).withColumn("amount", F.when(F.col("id") == 15, "x").otherwise(F.col("amount")))
    done = load(bad, path, BIG, book, load_id="l", max_rows=10)
    assert (done.rows_written, done.failed_loads, done.rejected_rows, done.bad_rows) == (0, 1, 30, 1)
    # the whole load comes back, with the reason on the bad row
    back = {r["id"]: r["_errors"] for r in done.rejected.collect()}
    assert sorted(back) == list(range(1, 31)) and [i for i, e in back.items() if e] == [15]
    assert "column 'amount'" in back[15][0]
    assert {r["status"] for r in L.read_ledger(spark, book).collect()} == {L.FAILED}
    # repaired, the same load goes in
    assert load(records(spark, 30), path, BIG, book, load_id="l", max_rows=10).rows_written == 30
    assert rows(spark, path) == list(range(1, 31))


def test_prefix_keeps_earlier_batches_and_a_retry_adds_the_rest(spark, where):
    path, book = where
    bad = records(spark, 30).withColumn("amount", F.when(F.col("id") == 15, "x").otherwise(F.col("amount")))
    done = load(bad, path, BIG, book, load_id="l", max_rows=10, unit="prefix", order_by=["id"], unique=True)
    assert (done.rows_written, done.inserts, done.failed_loads) == (10, 1, 1) and rows(spark, path) == list(range(1, 11))
    again = load(records(spark, 30), path, BIG, book, load_id="l", max_rows=10, unit="prefix", order_by=["id"], unique=True)
    assert (again.rows_written, again.duplicate_inserts) == (30, 1)
    assert rows(spark, path) == list(range(1, 31))


def test_row_unit_drops_only_bad_rows(spark, where):
    path, book = where
    bad = records(spark, 30).withColumn("amount", F.when(F.col("id") % 10 == 5, "x").otherwise(F.col("amount")))
    done = load(bad, path, BIG, book, load_id="l", max_rows=10, unit="row")
    assert (done.rows_written, done.inserts, done.rejected_rows) == (27, 3, 3) and len(rows(spark, path)) == 27


def test_many_loads_with_a_hot_one(spark, where):
    path, book = where
    df = records(spark, 300).withColumn("load_id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 20)))
    df = df.withColumn("amount", F.when(F.col("id") == 7, "x").otherwise(F.col("amount")))
    done = load(df, path, BIG, book, order_by=["id"], max_rows=7)
    lost = {i for i in range(1, 301) if i % 3 and i % 20 == 7}
    assert done.failed_loads == 1 and done.bad_rows == 1 and {r["id"] for r in done.rejected.collect()} == lost and rows(spark, path) == sorted(set(range(1, 301)) - lost)
    again = load(df, path, BIG, book, order_by=["id"], max_rows=7)
    assert again.duplicate_inserts == again.inserts == done.inserts and len(rows(spark, path)) == 300 - len(lost)


@pytest.mark.parametrize("many", [False, True])
@pytest.mark.parametrize("lost_at", ["ledger", "move"])
def test_a_crash_is_repaired_by_the_next_call(spark, where, monkeypatch, many, lost_at):
    path, book = where
    df = records(spark, 50).withColumn("load_id", F.concat(F.lit("m"), F.col("id") % 3)) if many else records(spark, 50)
    kwargs = {"order_by": ["id"], "max_rows": 20} if many else {"load_id": "l", "max_rows": 20}

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(L, "append_ledger", crash) if lost_at == "ledger" else m.setattr("quayside.operators.load._show", crash)
        with pytest.raises(RuntimeError):
            load(df, path, BIG, book, **kwargs)
    again = load(df, path, BIG, book, **kwargs)
    # with the ledger written the load counts as done, and its data comes into place
    assert (again.duplicate_inserts > 0) == (lost_at == "move")
    assert rows(spark, path) == list(range(1, 51))
    assert not [c for c in Storage(spark).children(path) if c.startswith("_staging")]


def test_attempts_are_counted(spark, where):
    path, book = where
    bad = records(spark, 3).withColumn("amount", F.lit("x"))
    for _ in range(3):
        load(bad, path, BIG, book, load_id="l")
    assert sorted(r["attempts"] for r in L.read_ledger(spark, book).collect()) == [1, 2, 3]


def test_a_replay_of_more_batches_than_any_window(spark, where):
    path, book = where
    for window in (None, 3):
        for k in range(2):
            done = load(records(spark, 100), path, BIG, book, load_id=f"l{window}", max_rows=10, window=window)
            assert (done.rows_written, done.inserts, done.duplicate_inserts) == (100, 10, 10 * k)
    by_load = records(spark, 100).withColumn("load_id", F.concat(F.lit("m"), F.col("id") % 2))
    for k in range(2):
        assert load(by_load, path, BIG, book, order_by=["id"], max_rows=10, window=3).duplicate_inserts == 10 * k
    assert len(rows(spark, path)) == 300


def test_a_known_load_is_not_read_again(spark, where):
    path, book = where
    load(records(spark, 20), path, BIG, book, load_id="l", max_rows=10)
    boom = records(spark, 20).withColumn("amount", F.raise_error(F.lit("read again")).cast("string"))
    again = load(boom, path, BIG, book, load_id="l", max_rows=10)
    assert (again.rows_written, again.duplicate_inserts) == (20, 2) and {r["attempts"] for r in again.batches.collect()} == {2}


def test_several_tokens_in_one_load_fail_it(spark, where):
    path, book = where
    df = records(spark, 10).withColumn("t", F.concat(F.lit("t"), F.col("id")))
    for unit in ("load", "row"):
        done = load(df, path, BIG, book, load_id=unit, token="t", unit=unit)
        assert (done.rows_written, done.failed_loads, done.rejected_rows) == (0, 1, 10) and "several tokens" in done.rejected.first()["_errors"][0]
    many = df.withColumn("load_id", F.when(F.col("id") < 5, "a").otherwise("b")).withColumn("t", F.when(F.col("id") < 5, "ta").otherwise(F.col("t")))
    done = load(many, path, BIG, book, order_by=["id"], token="t", max_rows=2)
    assert (done.rows_written, done.failed_loads, done.rejected_rows) == (4, 1, 6)
    assert rows(spark, path) == [1, 2, 3, 4]


def test_a_failing_write_is_noted_with_its_causes(spark, where, monkeypatch):
    path, book = where

    def lost(*_):
        raise RuntimeError("write failed") from ConnectionResetError("reset by peer")

    for k, (kind, status) in enumerate(((lost, L.RETRY), (lambda *_: 1 / 0, L.FAILED))):
        with monkeypatch.context() as m:
            m.setattr("quayside.operators.load._show", kind)
            with pytest.raises((RuntimeError, ZeroDivisionError)):
                load(records(spark, 5), f"{path}{k}", BIG, f"{book}{k}", load_id="l")
        noted = L.error_message(L.read_ledger(spark, f"{book}{k}").where(F.size("causes") > 0)).first()
        assert noted["status"] == status and noted["load_id"] == "l" and noted["attempts"] >= 1 and noted["error"]
    pending = spark.createDataFrame([("l",)], "load_id string")
    assert L.retry_select(pending, L.read_ledger(spark, f"{book}0")).count() == 1 and L.retry_select(pending, L.read_ledger(spark, f"{book}1")).count() == 0


def test_token_from_a_column(spark, where):
    path, book = where
    df = records(spark, 10).withColumn("batch", F.lit("b-1"))
    assert load(df, path, BIG, book, load_id="x", token="batch").duplicate_inserts == 0
    # another load under the same token is dropped, whatever it contains
    other = records(spark, 20).where("id > 10").withColumn("batch", F.lit("b-1"))
    assert load(other, path, BIG, book, load_id="y", token="batch").duplicate_inserts == 1
    blank = load(other.withColumn("batch", F.lit(" ")), path, BIG, book, load_id="z", token="batch")
    assert blank.failed_loads == 1 and "missing or empty" in blank.rejected.first()["_errors"][0]
    assert rows(spark, path) == list(range(1, 11))


def test_without_a_token_a_second_run_adds_again(spark, where):
    path, book = where
    for _ in range(2):
        load(records(spark, 5), path, BIG, book, load_id="x", token="none")
    assert rows(spark, path) == sorted([1, 2, 3, 4, 5] * 2)


def test_tokens_leave_the_window(spark, where):
    path, book = where
    for load_id in ("a", "b", "c"):
        load(records(spark, 1), path, BIG, book, load_id=load_id, window=2)
    assert load(records(spark, 1), path, BIG, book, load_id="b", window=2).duplicate_inserts == 1
    # a load's own tokens count for ever; those of others leave the window
    assert load(records(spark, 1), path, BIG, book, load_id="a", window=2).duplicate_inserts == 1
    other = records(spark, 1).withColumn("t", F.lit("a"))
    assert load(other, path, BIG, book, load_id="d", token="t", window=2).duplicate_inserts == 0


def test_absent_columns_take_defaults_and_added_ones_read_as_null(spark, where):
    path, book = where
    table = [ColumnSpec("id", "UInt32"), ColumnSpec("name", "String", default="'none'"), ColumnSpec("created", "DateTime", default="now()"), ColumnSpec("score", "Nullable(Float64)")]
    load(spark.createDataFrame([(1,)], "id int"), path, table, book, load_id="a")
    wider = [*table, ColumnSpec("extra", "Int8")]
    load(spark.createDataFrame([(2, "x", 5)], "id int, name string, extra int"), path, wider, book, load_id="b")
    first, second = read_target(spark, path, wider).orderBy("id").collect()
    assert (first["name"], first["score"], first["extra"]) == ("none", None, None) and first["created"].year >= 2024
    assert (second["name"], second["extra"]) == ("x", 5)


def test_a_load_needs_an_id(spark, where):
    with pytest.raises(ValueError, match="load_id"):
        load(records(spark, 1), where[0], BIG, where[1])


def test_unknown_fields_fail_before_any_job(spark, where):
    with pytest.raises(AlignmentError, match="nope"):
        load(records(spark, 1).withColumn("nope", F.lit(1)), *(where[0], BIG, where[1]), load_id="x")
    with pytest.raises(ValueError):
        load(records(spark, 1), where[0], BIG, where[1], load_id="x", unit="prefix")
