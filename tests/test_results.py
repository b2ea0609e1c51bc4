"""Result forms, JSON text, exports, sources, queries, statements, streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.convert import ERRORS
from quayside.functions.jsontext import json_flatten, json_rows
from quayside.functions.normalize import ResultError, normalize, output_schema
from quayside.operators import statements as S
from quayside.operators.export import export
from quayside.operators.queries import QueryError, run_per_key, run_queries, run_query
from quayside.plans.storage import Storage
from quayside.sources.readers import pull_increment, read_checked, read_json_strict, read_records, table_spec
from quayside.streaming.stream import StreamSettingError, stream_load
from quayside.operators.load import load_table, read_target
from quayside.types import ColumnSpec, spec


def test_output_types():
    cases = {
        "Int8": "int", "UInt16": "int", "Int32": "int", "UInt32": "bigint", "Int64": "bigint", "UInt64": "decimal(20,0)", "Int256": "string", "Float32": "float",
        "Float64": "double", "Decimal(10, 3)": "decimal(10,3)", "Bool": "boolean", "UUID": "string", "Date32": "date", "DateTime64(3)": "timestamp",
        "Array(Array(UInt8))": "array<array<int>>", "Map(UInt8, Float64)": "map<string,double>", "Tuple(Int8, name String)": "struct<_1:int,name:string>",
        "Nullable(Int8)": "int", "LowCardinality(String)": "string", "IPv6": "string", "JSON": "string", "Enum8('a' = 1)": "string", "Point": "string",
    }
    schema = output_schema([ColumnSpec(f"c{i}", t) for i, t in enumerate(cases)])
    assert [f.dataType.simpleString() for f in schema] == list(cases.values()) and all(f.nullable for f in schema)


def test_values_and_duplicate_names(spark):
    df = spark.createDataFrame([(b"ab\0\0", 2, [1], {1: "x"}, ("q", 3), 3232235777, bytearray(b"\x20\x01" + b"\0" * 13 + b"\x01"), None)],
                               "fs binary, e int, a array<int>, m map<int,string>, t struct<a:string,b:int>, ip bigint, six binary, n array<int>")
    row = normalize(df, spec(("fs", "FixedString(4)"), ("e", "Enum8('one' = 1, 'two' = 2)"), ("a", "Array(Int64)"), ("m", "Map(Int32, String)"),
                             ("t", "Tuple(String, Int32)"), ("ip", "IPv4"), ("six", "IPv6"), ("n", "Array(Int32)"))).first()
    assert (row["fs"], row["e"], row["a"], row["m"], row["t"].asDict()) == ("ab", "two", [1], {"1": "x"}, {"_1": "q", "_2": 3})
    assert (row["ip"], row["six"], row["n"]) == ("192.168.1.1", "2001:0:0:0:0:0:0:1", None)
    with pytest.raises(ResultError, match="x"):
        normalize(spark.sql("select 1 as x, 2 as x"))


def test_json_text(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), None, dt.datetime(2024, 3, 15, 13, 45, 10, 120000), dt.date(2024, 1, 2), b"\x01\x02", {2: [1.5, float("inf")]}, (None,))],
        "i int, d double, n string, t timestamp_ntz, day date, raw binary, m map<int,array<double>>, s struct<x:int>",
    )
    line = json_rows(df, "Europe/Bucharest").first()["json"]
    assert line == '{"i":1,"d":null,"n":null,"t":"2024-03-15T11:45:10.120Z","day":"2024-01-02","raw":"AQI=","m":{"2":[1.5,null]},"s":{"x":null}}'
    exact = spark.sql("select cast('123.4500' as decimal(10,4)) d, timestamp'2024-03-15 11:45:10Z' t, 'Stăvilar' s, map('k', 7) m, named_struct('_1', 1, '_2', 'a') t2")
    assert json_rows(exact).first()["json"] == '{"d":123.4500,"t":"2024-03-15T11:45:10Z","s":"Stăvilar","m":{"k":7},"t2":{"_1":1,"_2":"a"}}'


def test_flat_members(spark):
    text = '{"read_rows":"2","elapsed_ns":"60800784","nested":{"x":1},"memory_usage":"4197420","open":"{x","n":null,"deep":[1]}'
    df = spark.createDataFrame([(1, text), (2, "not json"), (3, ""), (4, None), (5, "[1]")], "id int, j string")
    got = {(r["id"], r["key"]): r["value"] for r in json_flatten(df, "j").collect()}
    assert got == {(1, "read_rows"): "2", (1, "elapsed_ns"): "60800784", (1, "memory_usage"): "4197420", (1, "open"): "{x", (1, "n"): "null"}


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_export_fragments_keep_the_result_order(spark, tmp_path, fmt):
    df = spark.range(25).select(F.col("id"), F.concat(F.lit("n"), F.col("id") % 7).alias("name")).repartition(5).orderBy(F.desc("id"))
    path = str(tmp_path / "out")
    done = export(df, path, fmt, max_rows=10)
    manifest = sorted(tuple(r) for r in done.manifest.collect())
    assert [(m[1], m[2], m[3]) for m in manifest] == [(0, 3, 10), (1, 3, 10), (2, 3, 5)] and {m[0] for m in manifest} == {done.identifier}
    want = list(range(24, -1, -1))
    for i in range(3):
        folder = f"{path}/fragment_index={i}"
        assert len([c for c in Storage(spark).children(folder) if c.startswith("part-")]) == 1
        if fmt == "json":
            got = [json.loads(r["value"])["id"] for r in spark.read.text(folder).collect()]
        else:
            reader = spark.read.option("header", True) if fmt == "csv" else spark.read
            got = [int(r["id"]) for r in reader.format(fmt).load(folder).collect()]
        assert got == want[10 * i: 10 * i + 10]


def test_export_whole_empty_and_failed(spark, tmp_path):
    whole = export(spark.range(5), str(tmp_path / "whole"))
    assert (whole.fragments, whole.rows) == (1, 5) and whole.manifest.first()["fragment_index"] is None
    empty = export(spark.range(0), str(tmp_path / "empty"), max_rows=3)
    assert (empty.fragments, empty.rows) == (1, 0) and empty.manifest.first()["record_count"] == 0
    assert spark.read.parquet(str(tmp_path / "empty")).columns == ["id", "fragment_index"]
    broken = spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("boom"))).otherwise(F.lit("x")).alias("v"))
    for n in (0, 3):
        with pytest.raises(Exception, match="boom"):
            export(broken, str(tmp_path / f"broken{n}"), max_rows=n)
    assert not [c for c in Storage(spark).children(str(tmp_path)) if "broken" in c]
    with pytest.raises(FileExistsError):
        export(spark.range(1), str(tmp_path / "whole"))


def test_csv_and_strict_json(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write("id,name,ts\n1,alpha,2024-01-01T00:00:00Z\n2,,x\n")
    df = read_records(spark, path, "csv")
    assert df.dtypes == [("id", "string"), ("name", "string"), ("ts", "string")] and df.count() == 2
    lines = spark.createDataFrame([('{"id":1,"n":"a"}',), ('{"id":1,"x":2,"y":3}',), ("{broken",), ("[1]",), (None,), ("{}",)], "l string")
    rows = read_json_strict(lines, "l", spec(("id", "Int32"), ("n", "String"))).collect()
    assert [(r["id"], r["n"], list(r[ERRORS])) for r in rows] == [
        ("1", "a", []), ("1", None, ["unknown field 'x'", "unknown field 'y'"]), (None, None, ["the text is not a JSON object"]),
        (None, None, ["the text is not a JSON object"]), (None, None, ["the text is not a JSON object"]), (None, None, []),
    ]
    bad = str(tmp_path / "lines.json")
    with open(bad, "w") as f:
        f.write('{"id":1}\n<junk>\n{"id":2}\n')
    good, unreadable = read_checked(spark, bad, "json", T.StructType([T.StructField("id", T.IntegerType())]))
    assert sorted(r["id"] for r in good.collect()) == [1, 2] and [r["raw"] for r in unreadable.collect()] == ["<junk>"]


def test_incremental_pull_reads_only_the_next_range(spark, tmp_path):
    spark.range(100).withColumn("v", F.col("id") * 2).write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    target, seen = spark.createDataFrame([], "id bigint, v bigint"), []
    while True:
        part = pull_increment(source, target, "id", 30)
        ids = sorted(r["id"] for r in part.collect())
        if not ids:
            break
        seen.append(ids)
        target = source.where(f"id <= {ids[-1]}")
    assert [len(s) for s in seen] == [30, 30, 30, 10] and sum(seen, []) == list(range(100))
    plan = pull_increment(source, source.where("id < 10"), "id", 30)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,9)" in plan and "LessThanOrEqual(id,39)" in plan
    ties = spark.createDataFrame([(1,), (2,), (2,), (2,), (3,)], "id int")
    assert sorted(r["id"] for r in pull_increment(ties, None, "id", 2).collect()) == [1, 2, 2, 2]


def test_incremental_pull_from_jdbc(spark):
    url = "jdbc:derby:memory:pull;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(50).selectExpr("id", "concat('c', id) as customer").write.jdbc(url, "orders", mode="overwrite", properties=props)
    source = spark.read.jdbc(url, "orders", properties=props)
    part = pull_increment(source, None, "id", 10, after=19)
    assert sorted(r["id"] for r in part.collect()) == list(range(20, 30))
    assert "GreaterThan" in part._jdf.queryExecution().executedPlan().toString()


def test_queries(spark):
    spark.range(10).createOrReplaceTempView("numbers_view")
    assert run_query(spark, "select count(*) n from identifier(:t) where id < :x", {"t": "numbers_view", "x": 4}).first()["n"] == 4
    for blank in (None, "", "  \n"):
        with pytest.raises(QueryError):
            run_query(spark, blank)
    control = spark.createDataFrame([("a", 2, "select id from numbers_view where id < :n"), ("b", 1, "select id from numbers_view where id < :n"), ("c", 1, " "), ("d", 1, None)], "tag string, n int, sql string")
    results, rejected, ran = run_queries(spark, control, args=["n"], keep=["tag"])
    assert sorted(tuple(r) for r in results.collect()) == [("a", 0), ("a", 1), ("b", 0)]
    assert sorted(r["tag"] for r in rejected.collect()) == ["c", "d"] and ran.where("query_id is not null").count() == 2
    broken = spark.createDataFrame([("a", "select nothing from no_such_table"), ("b", "select 1 as x")], "tag string, sql string")
    results, rejected, ran = run_queries(spark, broken, keep=["tag"])
    assert [tuple(r) for r in results.collect()] == [("b", 1)] and ran.count() == 1
    assert rejected.first()["tag"] == "a" and "no_such_table" in rejected.first()["error"]
    with pytest.raises(QueryError, match="nope"):
        run_queries(spark, broken, args=["nope"])
    keyed = run_per_key(spark.range(10), spark.createDataFrame([(3, "x"), (4, "y")], "id bigint, tag string"), "id", ["tag"])
    assert sorted(tuple(r) for r in keyed.collect()) == [(3, "x"), (4, "y")]


@pytest.fixture()
def people(spark, tmp_path):
    name = f"people_{abs(hash(str(tmp_path))) % 10**8}"
    columns = [ColumnSpec("id", "UInt32"), ColumnSpec("name", "String", default="'none'"), ColumnSpec("kind", "Enum8('a' = 1, 'b c/d' = 2)")]
    S.create_table(spark, name, columns, partition_by=["kind"], path=str(tmp_path / "t"))
    S.insert_select(spark, name, "select cast(id as bigint) as id, concat('n', id) as name, if(id % 2 = 0, 'a', 'b c/d') as kind from range(1000)")
    yield name
    S.drop(spark, name)


def test_table_life(spark, people):
    assert [(s.name, s.type_text, s.default) for s in table_spec(spark, people)] == [("id", "UInt32", None), ("name", "String", "'none'"), ("kind", "Enum8('a' = 1, 'b c/d' = 2)", None)]
    done = S.delete_where(spark, people, "id < 500 and kind = 'b c/d'")
    assert (done.read_rows, done.result_rows, done.written_rows) == (500, 250, 250)  # the other folder was not read
    assert spark.table(people).count() == 750
    assert S.delete_where(spark, people, "id < 0").read_rows == 0
    assert S.delete_where(spark, people, "name is null or id = 999").result_rows == 1
    S.update_where(spark, people, "id >= 990", {"name": "upper(name)"})
    assert sorted(r["name"] for r in spark.table(people).where("id >= 995").collect()) == ["N995", "N996", "N997", "N998"]
    assert S.delete_where(spark, people, "kind = 'a'").result_rows == 500 and spark.table(people).select("kind").distinct().count() == 1
    S.insert_select(spark, people, "select 5000L as id, 'a' as kind")
    assert spark.table(people).where("id = 5000").first()["name"] == "none"
    S.compact(spark, people, ["id"], files=1)
    assert spark.table(people).select(F.input_file_name()).distinct().count() == 2 and spark.table(people).count() == 250
    S.add_columns(spark, people, spec(("score", "Nullable(Float64)")))
    assert [s.name for s in table_spec(spark, people)] == ["id", "name", "score", "kind"] and spark.table(people).where("score is null").count() == 250
    with pytest.raises(S.StatementError):
        S.update_where(spark, people, "true", {"kind": "'a'"})
    with pytest.raises(S.StatementError):
        S.run(spark, " ")
    counted = S.run(spark, "select * from identifier(:t)", {"t": people})
    assert counted.result_rows == 250 and counted.elapsed_ns > 0 and counted.flat()["summary.result_rows"] == "250"
    S.truncate(spark, people)
    assert spark.table(people).count() == 0
    with pytest.raises(ValueError, match="does not exist"):
        table_spec(spark, "no_such_table")


def test_a_failed_rewrite_changes_nothing(spark, people, monkeypatch):
    with pytest.raises(Exception, match="boom"):
        S.update_where(spark, people, "id > 3", {"name": "raise_error('boom')"})
    moves = []
    real = Storage.move

    def fail_second(self, a, b):
        moves.append(a)
        if len(moves) == 2:
            raise OSError("disk")
        real(self, a, b)

    with monkeypatch.context() as m:
        m.setattr(Storage, "move", fail_second)
        with pytest.raises(OSError):
            S.delete_where(spark, people, "id > 3")
    spark.catalog.refreshTable(people)
    assert spark.table(people).count() == 1000


def test_a_loaded_table_lives_on(spark, tmp_path):
    name = f"loaded_{abs(hash(str(tmp_path))) % 10**8}"
    S.create_table(spark, name, [ColumnSpec("id", "UInt32"), ColumnSpec("name", "String", default="'none'")], path=str(tmp_path / "t"))
    book = str(tmp_path / "ledger")
    ids = spark.range(20).select(F.col("id").cast("string").alias("id"))
    for _ in range(2):
        load_table(ids, name, book, load_id="one").close()
    assert spark.table(name).count() == 20 and spark.table(name).where("name = 'none'").count() == 20
    assert S.delete_where(spark, name, "id = 3").result_rows == 1 and spark.table(name).count() == 19
    S.add_columns(spark, name, [ColumnSpec("score", "Int32", default="7")])
    load_table(spark.range(20, 30).select(F.col("id").cast("string").alias("id")), name, book, load_id="two").close()
    assert spark.table(name).count() == 29 and spark.table(name).where("score = 7").count() == 10 and spark.table(name).where("score is null").count() == 19
    assert S.update_where(spark, name, "id >= 25", {"name": "'late'"}).result_rows == 5 and spark.table(name).where("name = 'late'").count() == 5
    assert S.compact(spark, name, ["id"], 1).written_rows == 29 and S.delete_where(spark, name, "id < 0").read_rows == 0
    S.drop(spark, name)


def test_archiving_by_the_clock_loses_nothing(spark, tmp_path):
    tag = abs(hash(str(tmp_path))) % 10**8
    columns = [ColumnSpec("id", "UInt32"), ColumnSpec("ts", "DateTime64(6)")]
    for t in ("live", "old"):
        S.create_table(spark, f"{t}_{tag}", columns, path=str(tmp_path / t))
    # every moment of the next seconds has rows that are about to match
    S.insert_select(spark, f"live_{tag}", "select id, timestampadd(MILLISECOND, cast(id as int) * 10 - 1000, now()) as ts from range(3000)")
    done = S.archive_move(spark, f"live_{tag}", f"old_{tag}", "ts < now()")
    live, old = ({r["id"] for r in spark.table(f"{t}_{tag}").collect()} for t in ("live", "old"))
    assert live | old == set(range(3000)) and not live & old and done.result_rows == len(old)
    with pytest.raises(S.StatementError, match="deterministic"):
        S.delete_where(spark, f"live_{tag}", "rand() < 0.5")


def test_a_lost_driver_is_undone_by_the_next_statement(spark, people, monkeypatch):
    real = Storage.move
    for lost_at in range(1, 6):
        moves = []

        def lose(self, a, b, moves=moves, lost_at=lost_at):
            moves.append(a)
            if len(moves) >= lost_at:
                raise KeyboardInterrupt
            real(self, a, b)

        with monkeypatch.context() as m:
            m.setattr(Storage, "move", lose)
            m.setattr(S, "_restore", lambda *_: None)  # the driver is gone, nobody cleans up
            m.setattr(Storage, "delete", lambda *_: None)
            with pytest.raises(KeyboardInterrupt):
                S.update_where(spark, people, "id > 3", {"name": "'x'"})
        assert S.delete_where(spark, people, "id < 0").result_rows == 0
        spark.catalog.refreshTable(people)
        assert spark.table(people).count() == 1000, lost_at


def test_stream_load_restarts_and_routes(spark, tmp_path):
    inbox, path, book = (str(tmp_path / n) for n in ("inbox", "target", "ledger"))
    spark.range(40).select(F.col("id").cast("string").alias("id")).repartition(4).write.text(inbox)
    lines = spark.readStream.text(inbox)
    stream = lines.select(F.when(F.col("value") == "7", "seven").otherwise(F.col("value")).alias("id"))
    target = spec(("id", "UInt32"))
    kwargs = {"unit": "row", "rejected_path": str(tmp_path / "bad"), "max_rows": 15}
    stream_load(stream, path, target, book, str(tmp_path / "cp"), "s", **kwargs).awaitTermination()
    first = sorted(r["id"] for r in read_target(spark, path).collect())
    assert first == [i for i in range(40) if i != 7]
    assert json.loads(spark.read.parquet(str(tmp_path / "bad")).first()["record"])["id"] is None
    # the last micro-batch again, as after a crash before the checkpoint was written
    for commit in (tmp_path / "cp" / "commits").iterdir():
        if commit.name.strip(".").startswith("0"):
            commit.unlink()
    stream_load(stream, path, target, book, str(tmp_path / "cp"), "s", **kwargs).awaitTermination()
    assert sorted(r["id"] for r in read_target(spark, path).collect()) == first
    # a new checkpoint is a new stream, whatever its name
    stream_load(stream, path, target, book, str(tmp_path / "cp2"), "s", **kwargs).awaitTermination()
    assert sorted(r["id"] for r in read_target(spark, path).collect()) == sorted(first * 2)
    with pytest.raises(StreamSettingError):
        stream_load(stream, path, target, book, str(tmp_path / "cp3"), "s", buffer="1 minute")
    with pytest.raises(StreamSettingError):
        stream_load(stream, path, target, book, str(tmp_path / "cp3"), "a/b")


def test_a_refused_unit_of_a_stream_is_not_lost(spark, tmp_path):
    inbox, path, book, bad = (str(tmp_path / n) for n in ("inbox", "target", "ledger", "bad"))
    spark.range(50).select(F.col("id").cast("string").alias("value")).coalesce(1).write.text(inbox)
    stream = spark.readStream.text(inbox).select(F.when(F.col("value") == "7", "seven").otherwise(F.col("value")).alias("id"))
    target = spec(("id", "UInt32"))
    for k, unit in enumerate(("row", "load")):  # nowhere to put them: the stream stops and nothing is loaded
        with pytest.raises(Exception, match="cannot be loaded"):
            stream_load(stream, path, target, book, str(tmp_path / f"cp{k}"), "s", unit=unit).awaitTermination()
    stream_load(stream, path, target, book, str(tmp_path / "cp"), "s", unit="load", rejected_path=bad).awaitTermination()
    back = spark.read.parquet(bad)
    assert back.count() == 50 and back.where("size(_errors) > 0").count() == 1
    stream_load(stream, path, target, book, str(tmp_path / "cp1"), "s", rejected_path=bad + "2").awaitTermination()
    assert read_target(spark, path, target).count() == 49 and spark.read.parquet(bad + "2").count() == 1


def test_buffered_stream(spark, tmp_path):
    inbox, path, book = (str(tmp_path / n) for n in ("inbox", "target", "ledger"))
    spark.range(30).select(F.col("id").cast("string").alias("id")).repartition(3).write.text(inbox)
    stream = spark.readStream.text(inbox).select(F.col("value").alias("id"))
    for _ in range(2):  # the second run replays the first batch
        query = stream_load(stream, path, spec(("id", "UInt32")), book, str(tmp_path / "a"), "s", token="none", buffer="1 second")
        query.processAllAvailable()
        query.stop()
        for commit in (tmp_path / "a" / "commits").iterdir():
            commit.unlink()
    assert sorted(r["id"] for r in read_target(spark, path).collect()) == list(range(30))
