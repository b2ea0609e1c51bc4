"""The load log under many calls and several writers, partitioned targets, files as units, queries that fail alone."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from quayside.operators import ledger as L
from quayside.operators import load as load_module
from quayside.operators import log as log_module
from quayside.operators import statements as S
from quayside.operators.load import Lease, load, load_table, read_target, recover
from quayside.operators.log import Log
from quayside.operators.queries import QueryError, outcomes, read_results, run_each
from quayside.plans.storage import Storage
from quayside.sources.readers import read_units
from quayside.types import ColumnSpec, spec

SMALL = spec(("id", "UInt64"), ("name", "String"))


@pytest.fixture()
def where(tmp_path):
    return str(tmp_path / "target"), str(tmp_path / "ledger")


def records(spark, a, b):
    return spark.range(a, b).selectExpr("CAST(id AS string) AS id", "'n' AS name")


def ids(spark, path):
    return sorted(int(r["id"]) for r in read_target(spark, path).select("id").collect())


def row(k, table="t"):
    return {"seq": k, "table": table, "load_id": f"l{k}", "token": f"l{k}", "batch_index": 0, "rows": 1, "status": L.ACCEPTED, "attempts": 1, "causes": [], "batches": 1}


def jobs(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_late_call_costs_what_an_early_one_does(spark, where, monkeypatch):
    monkeypatch.setattr(log_module, "MERGE_AFTER", 4)
    monkeypatch.setattr(L, "MERGE_AFTER", 4)
    path, book = where
    counts = [jobs(spark, lambda k=k: load(records(spark, k * 10, k * 10 + 10), path, SMALL, book, load_id=f"l{k}").close()) for k in range(14)]
    assert max(counts) <= 4 and max(counts[10:]) <= max(counts[2:6])
    assert ids(spark, path) == list(range(140))
    at = Log(spark, book).snapshot()
    assert at.number == 13 and len(at.tail) < 4 and at.next == {"target": 14}
    assert sorted(r["seq"] for r in L.read_ledger(spark, book).collect()) == list(range(14))


def test_merged_parts_grow_like_binary_digits(spark, where):
    _, book = where
    for k in range(65):
        L.append_ledger([row(k)], book, spark=spark)
    at = Log(spark, book).snapshot()
    sizes = [p["rows"] for p in at.parts]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) <= 3 and sum(sizes) + len(at.tail) == 65
    assert sorted(r["load_id"] for r in L.read_ledger(spark, book).collect()) == sorted(f"l{k}" for k in range(65))


def test_the_log_is_read_without_the_hint_of_the_last_merge(spark, where):
    _, book = where
    for k in range(12):
        L.append_ledger([row(k)], book, spark=spark)
    Storage(spark).delete(f"{book}/_log/_last")
    assert L.read_ledger(spark, book).count() == 12


def test_an_entry_has_one_writer(spark, where):
    _, book = where
    log = Log(spark, book)
    at = log.snapshot()
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append(log.put({"commit": str(k)}, at))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 7 + [True]
    L.append_ledger([row(0)], book, spark=spark)
    with pytest.raises(L.ConflictError):
        L.append_ledger([row(1)], book, "c", at, spark)


@pytest.mark.parametrize("same", [True, False])
def test_two_writers_at_once(spark, where, same):
    path, book = where
    done = {}

    def write(k):
        a = 0 if same else 100 * k
        done[k] = load(records(spark, a, a + 100), path, SMALL, book, load_id="one" if same else f"l{k}", max_rows=30)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) == 3 and ids(spark, path) == list(range(100 if same else 300))
    assert sorted(d.duplicate_inserts for d in done.values()) == ([0, 4, 4] if same else [0, 0, 0])
    told = L.read_ledger(spark, book).collect()
    assert len({r["seq"] for r in told}) == len(told) == 12


def test_a_writer_that_comes_second_judges_again(spark, where, monkeypatch):
    """Between reading the ledger and writing its entry another call loads the same tokens."""
    path, book = where
    plain, first = L.append_ledger, []

    def late(*args):
        if not first:
            first.append(True)
            load(records(spark, 0, 50), path, SMALL, book, load_id="l", max_rows=20)
        return plain(*args)

    with monkeypatch.context() as m:
        m.setattr(L, "append_ledger", late)
        done = load(records(spark, 0, 50), path, SMALL, book, load_id="l", max_rows=20)
    assert (done.inserts, done.duplicate_inserts) == (3, 3) and ids(spark, path) == list(range(50))
    assert not Storage(spark).exists(f"{path}/{load_module.STAGING}")


def test_files_under_a_lease_are_spared(spark, where):
    path, book = where
    files = Storage(spark)
    with Lease(spark, path, "busy"):
        records(spark, 0, 5).write.parquet(f"{path}/{load_module.STAGING}/busy")
        load(records(spark, 5, 10), path, SMALL, book, load_id="other")
        assert files.exists(f"{path}/{load_module.STAGING}/busy")
    recover(spark, path, book)
    assert not files.exists(f"{path}/{load_module.STAGING}") and ids(spark, path) == list(range(5, 10))
    assert any("busy" in e.get("undone", ()) for e in Log(spark, book).snapshot().tail)


def test_a_slow_writer_whose_files_were_cleared_stops(spark, where, monkeypatch):
    path, book = where
    monkeypatch.setattr(Lease, "SECONDS", -1)
    plain, first = L.append_ledger, []

    def late(*args):
        if not first:
            first.append(True)
            recover(spark, path, book)
        return plain(*args)

    with monkeypatch.context() as m:
        m.setattr(L, "append_ledger", late)
        m.setattr(Lease, "_renew", lambda self: None)
        with pytest.raises(RuntimeError, match="cleared away"):
            load(records(spark, 0, 5), path, SMALL, book, load_id="l")
    monkeypatch.setattr(Lease, "SECONDS", 120)
    assert load(records(spark, 0, 5), path, SMALL, book, load_id="l").rows_written == 5 and ids(spark, path) == list(range(5))


@pytest.fixture()
def parted(spark, tmp_path):
    name = f"parted_{uuid.uuid4().hex}"
    S.create_table(spark, name, [ColumnSpec("id", "UInt32"), ColumnSpec("note", "String", default="'x'"), ColumnSpec("p", "String")], partition_by=["p"], path=str(tmp_path / name))
    yield name
    S.drop(spark, name)


def test_partitioned_targets(spark, parted, tmp_path):
    rows = spark.range(100).selectExpr("CAST(id AS string) AS id", "IF(id % 4 = 0, NULL, concat('p', id % 4)) AS p")
    for load_id, some in (("a", rows.where("CAST(id AS int) < 50")), ("b", rows.where("CAST(id AS int) >= 50")), ("a", rows.where("CAST(id AS int) < 50"))):
        load_table(some, parted, str(tmp_path / "book"), load_id=load_id, max_rows=10)
    got = spark.table(parted)
    assert got.count() == 100 and {r["note"] for r in got.collect()} == {"x"}
    assert {r["p"]: r["n"] for r in got.groupBy("p").agg(F.count("*").alias("n")).collect()} == {None: 25, "p1": 25, "p2": 25, "p3": 25} or got.where("p IS NULL").count() in (0, 25)
    assert spark.sql(f"SHOW PARTITIONS {parted}").count() == 4


def test_a_driver_lost_between_two_partitions_is_repaired(spark, parted, tmp_path, monkeypatch):
    rows = spark.range(40).selectExpr("CAST(id AS string) AS id", "concat('p', id % 4) AS p")
    book, plain, moved = str(tmp_path / "book"), Storage.move, []

    def lost(self, a, b):
        if load_module.STAGING in a:
            moved.append(b)
            if len(moved) == 3:
                raise RuntimeError("lost the driver")
        return plain(self, a, b)

    with monkeypatch.context() as m:
        m.setattr(Storage, "move", lost)
        with pytest.raises(RuntimeError):
            load_table(rows, parted, book, load_id="a")
    assert 0 < spark.table(parted).count() < 40
    done = load_table(rows, parted, book, load_id="a")
    assert done.duplicate_inserts == done.inserts and spark.table(parted).count() == 40


def test_files_as_units(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a b.csv").write_text('id,name\n1,x\n2,"y, ""z"""\n')
    (folder / "b.csv").write_text("name,id\nu,3\nv\n")
    (folder / "c.csv").write_text("")
    (folder / "d.csv").write_text("id\n4\n")
    units = read_units(spark, str(folder), "csv", SMALL, by_header=True, names_only=True)
    path, book = str(tmp_path / "t"), str(tmp_path / "l")
    done = load(units, path, SMALL, book, order_by=["id"])
    assert ids(spark, path) == [1, 2, 4] and done.failed_loads == 1 and done.bad_rows == 1
    back = {r["load_id"]: r["_errors"] for r in done.rejected.where(F.size("_errors") > 0).collect()}
    assert list(back) == ["b.csv"] and back["b.csv"][0].startswith("malformed csv record: v")
    assert done.rejected.count() == 2 and read_target(spark, path).where("id = 2").first()["name"] == 'y, "z"'


def test_heads_are_read_not_files(spark, tmp_path):
    big = tmp_path / "big.csv"
    big.write_text("id,name\n" + "1,x\n" * 200_000)
    assert Storage(spark).first_line(str(big)) == "id,name"
    assert Storage(spark).first_line(str(tmp_path / "none.csv")) == "" if (tmp_path / "none.csv").exists() else True


def test_queries_fail_alone(spark, tmp_path):
    sql = "SELECT IF(id = :n, assert_true(false, 'stopped'), id) AS id FROM range(10)"
    control = spark.createDataFrame(
        [(1, "SELECT id FROM range(:n + 3)"), (2, "SELECT id / 0 AS q, assert_true(id < 5) AS ok FROM range(10)"), (3, sql), (4, " "), (5, "SELECT nonsense"), (6, "SELECT 'text' AS other"), (7, None)],
        "n int, sql string",
    )
    into = str(tmp_path / "results")
    found = outcomes(spark, control, list(run_each(spark, control, into, args=["n"], keep=["n"], at_once=3))).collect()
    by = {r["n"]: r for r in found}
    assert sorted(by) == [1, 2, 3, 4, 5, 6, 7]
    assert {n for n, r in by.items() if r["error"] is None} == {1, 6} and by[1]["rows"] == 4 and by[6]["rows"] == 1
    assert "nonsense" in by[5]["error"] and by[4]["error"] == by[7]["error"] == "no SQL query"
    assert sorted(Storage(spark).children(into)) == sorted(f"query_id={by[n]['query_id']}" for n in (1, 6))
    got = read_results(spark, into)
    assert sorted(r["id"] for r in got.where("n = 1").collect()) == [0, 1, 2, 3] and got.where("n = 6").first()["other"] == "text"
    with pytest.raises(QueryError):
        list(run_each(spark, control, into, args=["absent"]))
    assert read_results(spark, str(tmp_path / "none")) is None
