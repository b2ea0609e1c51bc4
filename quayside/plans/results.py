"""Registered queries: result forms, JSON, exports, parameterised queries and statements."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quayside.functions.jsontext import json_flatten
from quayside.functions.jsontext import json_rows as to_json_rows
from quayside.functions.normalize import normalize
from quayside.operators import statements as S
from quayside.operators.export import export
from quayside.operators.queries import run_queries, run_query
from quayside.plans.session import Scratch
from quayside.plans.tables import Registry, table
from quayside.types import spec

registry = Registry()


@registry.add("""
    SELECT l_orderkey, l_linenumber::INT AS l_linenumber, l_quantity::INT AS small, l_partkey::VARCHAR AS wide,
           l_extendedprice::DECIMAL(18, 2)::VARCHAR AS price, l_returnflag AS flag,
           CASE l_linestatus WHEN 'O' THEN 'open' ELSE 'filled' END AS status, l_shipdate::DATE AS shipped, epoch_us(l_shipdate) AS shipped_us
    FROM lineitem
""")
def normalize_types(spark, sf_dir):
    """Result types and scalar values."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("tinyint"), F.col("l_quantity").cast("smallint").alias("small"),
        F.col("l_partkey").cast("decimal(20,0)").alias("wide"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.concat("l_returnflag", F.lit("\0\0\0")).alias("flag"), F.when(F.col("l_linestatus") == "O", 1).otherwise(-2).alias("status"),
        F.col("l_shipdate").cast("date").alias("shipped"), F.col("l_shipdate").cast("timestamp").alias("shipped_us"),
    )
    columns = spec(("l_orderkey", "Int64"), ("l_linenumber", "UInt8"), ("small", "Int16"), ("wide", "UInt64"), ("price", "Decimal(18, 2)"),
                   ("flag", "FixedString(4)"), ("status", "Enum8('open' = 1, 'filled' = -2)"), ("shipped", "Date"), ("shipped_us", "DateTime64(6)"))
    done = normalize(lines, columns)
    return done.withColumn("wide", F.col("wide").cast("string")).withColumn("price", F.col("price").cast("string")).withColumn("shipped_us", F.unix_micros("shipped_us"))


@registry.add("""
    SELECT p_partkey, p_size || '=' || p_name || ';' || (p_size + 100) || '=' || p_brand AS by_number, p_name AS first_name, '' AS not_a_map
    FROM part
""")
def map_keys(spark, sf_dir):
    """Map keys as text, a scalar where an array is due, something else where a map is due."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.create_map("p_size", "p_name", F.col("p_size") + 100, "p_brand").alias("by_number"), F.col("p_name").alias("names"),
        F.col("p_brand").alias("not_a_map"),
    )
    done = normalize(parts, spec(("p_partkey", "Int64"), ("by_number", "Map(Int32, String)"), ("names", "Array(String)"), ("not_a_map", "Map(String, String)")))
    shown = F.transform(F.map_entries("by_number"), lambda e: F.concat(e.key, F.lit("="), e.value))
    return done.select("p_partkey", F.array_join(shown, ";").alias("by_number"), F.col("names")[0].alias("first_name"),
                       F.array_join(F.map_keys("not_a_map"), ",").alias("not_a_map"))


@registry.add("""
    SELECT c_custkey, c_name AS _1, c_nationkey::BIGINT AS _2, c_mktsegment AS segment FROM customer
""")
def tuple_names(spark, sf_dir):
    """A tuple as a record, its unnamed elements numbered."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.struct("c_name", "c_nationkey", "c_mktsegment").alias("t"))
    done = normalize(rows, spec(("c_custkey", "Int64"), ("t", "Tuple(String, Int64, segment String)")))
    named = normalize(rows, spec(("c_custkey", "Int64"), ("t", "Tuple(String, Int64, String)")))
    assert named.schema["t"].dataType.fieldNames() == ["_1", "_2", "_3"]
    return done.select("c_custkey", "t._1", "t._2", "t.segment")


@registry.add("""
    SELECT event_id, ((event_id * 7919) >> 24 & 255) || '.' || ((event_id * 7919) >> 16 & 255) || '.' || ((event_id * 7919) >> 8 & 255) || '.' || (event_id * 7919 & 255) AS ip
    FROM events
""")
def ip_text(spark, sf_dir):
    """Packed addresses as text."""
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") * 7919).alias("ip"))
    return normalize(rows, spec(("event_id", "Int64"), ("ip", "IPv4")))


@registry.add("""
    SELECT p_brand AS brand, p_partkey::VARCHAR AS partkey, '{"name":"' || p_name || '","sizes":[' || p_size || ',null]}' AS doc, CAST(NULL AS DOUBLE) AS missing
    FROM part
""")
def output_projection(spark, sf_dir):
    """Nested values as JSON text, projected onto a writer's schema."""
    from pyspark.sql import types as T

    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("brand"),
        F.struct(F.col("p_name").alias("name"), F.array("p_size", F.lit(None).cast("int")).alias("sizes")).alias("doc"),
        F.col("p_partkey").alias("partkey"),
    )
    schema = T.StructType().add("brand", "string").add("partkey", "string").add("doc", "string").add("missing", "double")
    return normalize(rows, spec(("p_partkey", "Int64"), ("brand", "String"), ("doc", "JSON"), ("partkey", "Int64")), schema)


@registry.add("""
    SELECT '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
           || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' WHEN epoch_us(ts) % 1000 = 0 THEN strftime(ts, '.%g') ELSE strftime(ts, '.%f') END
           || 'Z","day":"' || strftime(ts, '%Y-%m-%d') || '","value":' || value::VARCHAR || ',"infinite":null,"none":null,"tags":{"1":["' || event_type || '"]},"raw":"'
           || base64(event_type::BLOB) || '"}' AS json
    FROM events
""")
def json_rows(spark, sf_dir):
    """Rows as JSON lines."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("ts").cast("date").alias("day"), "value", F.lit(float("inf")).alias("infinite"), F.lit(None).cast("string").alias("none"),
        F.create_map(F.lit(1), F.array("event_type")).alias("tags"), F.col("event_type").cast("binary").alias("raw"),
    )
    return to_json_rows(rows)


@registry.add("""
    SELECT event_id, 'k' AS key, regexp_extract(props, '[0-9]+') AS value FROM events WHERE event_id % 23 <> 9
    UNION ALL SELECT event_id, 'type', '{' || event_type FROM events WHERE event_id % 23 <> 9
    UNION ALL SELECT event_id, 'nothing', 'null' FROM events WHERE event_id % 23 <> 9
    UNION ALL SELECT event_id, 'big', event_id || 'e400' FROM events WHERE event_id % 23 <> 9
    UNION ALL SELECT event_id, 'fine', event_id || '.0' FROM events WHERE event_id % 23 <> 9
    UNION ALL SELECT event_id, 'a "key" ' || chr(92), '"' || event_type || '" ' || chr(92) FROM events WHERE event_id % 23 <> 9
""")
def flatten_json(spark, sf_dir):
    """Flat members of JSON objects, as they are spelled; nested members, broken text and repeated keys give nothing."""
    text = F.concat(F.lit('{"type": "{'), F.col("event_type"), F.lit('", "nothing": null, "deep": {"x": 1}, "list": [1], "big": '), F.col("event_id"), F.lit('e400, "fine": '), F.col("event_id"),
                    F.lit('.0, "a \\"key\\" \\\\": "\\"'), F.col("event_type"), F.lit('\\" \\\\", "k": '), F.regexp_extract("props", "[0-9]+", 0), F.lit("}"))
    broken = F.when(F.col("event_id") % 92 == 9, F.lit('{"a": 1, "a": 2}')).when(F.col("event_id") % 46 == 9, F.lit("not json")).when(F.col("event_id") % 23 == 9, F.lit("")).otherwise(text)
    return json_flatten(table(spark, sf_dir, "events").select("event_id", broken.alias("summary")), "summary").select("event_id", "key", "value")


@registry.add("""
    WITH numbered AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS i FROM orders)
    SELECT i // 1000 AS fragment_index, count(*) AS record_count, (SELECT ceil(count(*) / 1000)::BIGINT FROM orders) AS fragment_count,
           count(*) AS rows_in_file, max(o_totalprice) AS first_price, min(o_totalprice) AS last_price, 1 AS files
    FROM numbered GROUP BY i // 1000
""")
def export_manifest(spark, sf_dir):
    """Orders by price in fragments of 1000, read back beside their manifest."""
    path = Scratch(spark).path("export")
    result = export(table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey"), path, "parquet", max_rows=1000)
    back = spark.read.parquet(path).select("fragment_index", "o_totalprice", F.input_file_name().alias("file")).groupBy("fragment_index").agg(
        F.count(F.lit(1)).alias("rows_in_file"), F.max("o_totalprice").alias("first_price"), F.min("o_totalprice").alias("last_price"),
        F.count_distinct("file").cast("int").alias("files"),
    )
    return result.manifest.select("fragment_index", "record_count", "fragment_count").join(back, "fragment_index")


@registry.add("""
    SELECT 0::BIGINT AS fragment_index, 1::BIGINT AS fragment_count, 0::BIGINT AS record_count, count(*) AS rows_in_files
    FROM orders WHERE o_totalprice < 0
""")
def export_empty(spark, sf_dir):
    """An empty result still makes one output."""
    path = Scratch(spark).path("export")
    result = export(table(spark, sf_dir, "orders").where("o_totalprice < 0"), path, "parquet", max_rows=1000)
    rows = spark.read.parquet(path).count()
    return result.manifest.select("fragment_index", "fragment_count", "record_count", F.lit(rows).cast("bigint").alias("rows_in_files"))


@registry.add("""
    SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS value FROM orders
""")
def export_json_lines(spark, sf_dir):
    """A result as JSON lines in one output."""
    path = Scratch(spark).path("export")
    export(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), path, "json")
    return spark.read.text(path)


def _view(spark, sf_dir, name: str) -> str:
    """A view of a given table under a name of its own."""
    view = f"{name}_{uuid.uuid4().hex[:8]}"
    table(spark, sf_dir, name).createOrReplaceTempView(view)
    return view


@registry.add("""
    SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders
    WHERE o_totalprice >= 250000 AND o_orderstatus = 'F' GROUP BY o_orderpriority
""")
def query_params(spark, sf_dir):
    """Values and the table name as bound arguments."""
    sql = """SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM IDENTIFIER(:source)
             WHERE o_totalprice >= :least AND o_orderstatus = :status GROUP BY o_orderpriority"""
    return run_query(spark, sql, {"source": _view(spark, sf_dir, "orders"), "least": 250000, "status": "F"})


@registry.add("""
    SELECT r_name, n_name, count(*) AS customers, sum(c_custkey)::BIGINT AS ids
    FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey GROUP BY r_name, n_name
""")
def control_queries(spark, sf_dir):
    """One query per region, its name on every result row."""
    nation, customer = _view(spark, sf_dir, "nation"), _view(spark, sf_dir, "customer")
    sql = f"""SELECT n_name, count(*) AS customers, sum(c_custkey) AS ids FROM {nation} JOIN {customer} ON n_nationkey = c_nationkey
              WHERE n_regionkey = :r_regionkey GROUP BY n_name"""
    control = table(spark, sf_dir, "region").withColumn("sql", F.lit(sql))
    blank = control.withColumn("sql", F.lit("  "))
    results, rejected, _ = run_queries(spark, control.unionByName(blank), args=["r_regionkey"], keep=["r_name"])
    assert rejected.count() == control.count()
    return results


ORDER_COLUMNS = spec(("o_orderkey", "Int64"), ("o_custkey", "Int64"), ("o_orderstatus", "LowCardinality(String)"), ("o_totalprice", "Float64"),
                     ("o_orderdate", "Date"), ("o_orderpriority", "String"))


def _orders_table(spark, sf_dir, partition_by=None, fill=True) -> str:
    """A fresh table for the orders, in the scratch folder."""
    name = f"orders_{uuid.uuid4().hex[:12]}"
    S.create_table(spark, name, ORDER_COLUMNS, partition_by=partition_by, path=Scratch(spark).path(name))
    if fill:
        view = _view(spark, sf_dir, "orders")
        S.insert_select(spark, name, f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM {view}")
    return name


_ORDER_ROWS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::DATE AS o_orderdate, o_orderpriority"


@registry.add("""
    SELECT o_orderkey, o_orderstatus, 'none' AS o_orderpriority, (SELECT count(*) FROM orders WHERE o_totalprice > 100000) AS written
    FROM orders WHERE o_totalprice > 100000
""")
def insert_select(spark, sf_dir):
    """A table with a default, filled by a filtered SELECT, with the written count."""
    name, view = f"orders_{uuid.uuid4().hex[:12]}", _view(spark, sf_dir, "orders")
    from quayside.types import ColumnSpec

    columns = [ColumnSpec("o_orderkey", "Int64"), ColumnSpec("o_orderstatus", "String"), ColumnSpec("o_orderpriority", "String", default="'none'")]
    S.create_table(spark, name, columns, path=Scratch(spark).path(name))
    done = S.insert_select(spark, name, f"SELECT o_orderstatus, o_orderkey FROM {view} WHERE o_totalprice > :least", {"least": 100000})
    return spark.table(name).withColumn("written", F.lit(done.written_rows).cast("bigint"))


@registry.add(f"SELECT {_ORDER_ROWS} FROM orders WHERE NOT (o_totalprice < 150000 AND o_orderstatus = 'P')")
def delete_where(spark, sf_dir):
    """Only the folder of the one status is rewritten."""
    name = _orders_table(spark, sf_dir, ["o_orderstatus"])
    S.delete_where(spark, name, "o_totalprice < 150000 AND o_orderstatus = 'P'")
    return spark.table(name)


@registry.add("""
    SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_custkey % 3 = 1 THEN 0 ELSE o_totalprice END::DOUBLE AS o_totalprice, o_orderdate::DATE AS o_orderdate,
           CASE WHEN o_custkey % 3 = 1 THEN 'was ' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority
    FROM orders
""")
def update_where(spark, sf_dir):
    """T7"""
    name = _orders_table(spark, sf_dir)
    S.update_where(spark, name, "o_custkey % 3 = 1", {"o_orderpriority": "concat('was ', o_orderpriority)", "o_totalprice": "0"})
    return spark.table(name)


@registry.add(f"SELECT {_ORDER_ROWS}, 1 AS files FROM orders")
def compact(spark, sf_dir):
    """Several inserts, then one ordered file."""
    name = _orders_table(spark, sf_dir, fill=False)
    view = _view(spark, sf_dir, "orders")
    for part in range(3):
        S.insert_select(spark, name, f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM {view} WHERE o_custkey % 3 = {part}")
    S.compact(spark, name, ["o_orderkey"], files=1)
    files = spark.table(name).select(F.input_file_name().alias("f")).distinct().count()
    return spark.table(name).withColumn("files", F.lit(files))


@registry.add("""
    SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'archive' ELSE 'live' END AS place, o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS ids
    FROM orders GROUP BY 1, 2
""")
def archive_move(spark, sf_dir):
    """T12"""
    live, archive = _orders_table(spark, sf_dir, ["o_orderstatus"]), _orders_table(spark, sf_dir, ["o_orderstatus"], fill=False)
    S.archive_move(spark, live, archive, "o_orderdate < DATE '1998-01-01'")
    rows = spark.table(live).withColumn("place", F.lit("live")).unionByName(spark.table(archive).withColumn("place", F.lit("archive")))
    return rows.groupBy("place", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("ids"))


@registry.add("""
    SELECT 'insert' AS statement, count(*) AS written_rows, 0::BIGINT AS result_rows FROM orders
    UNION ALL SELECT 'select', 0, count(*) FROM orders WHERE o_totalprice > 300000
    UNION ALL SELECT 'delete', count(*) FILTER (o_orderkey % 2 = 0), count(*) FILTER (o_orderkey % 2 = 1) FROM orders
    UNION ALL SELECT 'truncate', 0, 0
    UNION ALL SELECT 'after truncate', 0, 0
""")
def statement_summary(spark, sf_dir):
    """What each statement of a table's life reports."""
    name, view = _orders_table(spark, sf_dir, fill=False), _view(spark, sf_dir, "orders")
    select = f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM {view}"
    done = {
        "insert": S.insert_select(spark, name, select),
        "select": S.run(spark, "SELECT * FROM IDENTIFIER(:t) WHERE o_totalprice > :p", {"t": name, "p": 300000}),
        "delete": S.delete_where(spark, name, "o_orderkey % 2 = 1"),
        "truncate": S.truncate(spark, name),
        "after truncate": S.run(spark, "SELECT * FROM IDENTIFIER(:t)", {"t": name}),
    }
    S.drop(spark, name)
    rows = [(k, s.written_rows, 0 if k == "insert" else s.result_rows) for k, s in done.items()]
    return spark.createDataFrame(rows, "statement string, written_rows bigint, result_rows bigint")
