"""Registered queries: sources, batches, tokens, replay, loads and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.convert import ERRORS, conform
from quayside.operators import ledger as L
from quayside.operators.batches import batch_token, base_token, cut_batches, token_error
from quayside.operators import statements as S
from quayside.operators.load import load, load_table, read_target
from quayside.operators.route import route
from quayside.plans.session import Scratch
from quayside.plans.tables import Registry, table
from quayside.sources.readers import pull_increment, read_checked, read_json_strict, read_records
from quayside.streaming.stream import drop_replayed, pending_units, stream_load
from quayside.types import ColumnSpec, spec

registry = Registry()

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]
_SQL_ORDER = ", ".join(LINE_ORDER)


@registry.add("""
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, 0 AS n_errors FROM orders
""")
def csv_records(spark, sf_dir):
    """Header CSV, every value text, converted on the way in."""
    path = Scratch(spark).path("csv")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").write.option("header", True).csv(path)
    records = read_records(spark, path, "csv")
    target = spec(("o_orderkey", "Int64"), ("o_custkey", "Int64"), ("o_totalprice", "Float64"), ("o_orderpriority", "String"))
    return conform(records, target).withColumn("n_errors", F.size(ERRORS)).drop(ERRORS)


@registry.add("""
    SELECT 'json' AS format, count(*) AS n, sum(event_id)::BIGINT AS ids, sum(user_id)::BIGINT AS users FROM events
    UNION ALL SELECT 'orc', count(*), sum(event_id)::BIGINT, sum(user_id)::BIGINT FROM events
    UNION ALL SELECT 'parquet', count(*), sum(event_id)::BIGINT, sum(user_id)::BIGINT FROM events
""")
def record_formats(spark, sf_dir):
    """The same records through three formats, aligned to one target."""
    scratch, events = Scratch(spark), table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    target, out = spec(("event_id", "Int64"), ("user_id", "UInt32"), ("event_type", "String")), None
    for fmt in ("json", "orc", "parquet"):
        path = scratch.path(fmt)
        events.write.format(fmt).save(path)
        rows = conform(read_records(spark, path, fmt, target if fmt == "json" else None), target)
        sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.sum("user_id").alias("users"))
        part = sums.select(F.lit(fmt).alias("format"), "n", "ids", "users")
        out = part if out is None else out.unionByName(part)
    return out


@registry.add("""
    SELECT event_id,
           CASE WHEN event_id % 17 <> 5 THEN regexp_extract(props, '[0-9]+')::INT END AS k,
           CASE WHEN event_id % 17 = 5 THEN 'the text is not a JSON object'
                WHEN event_id % 13 = 4 THEN 'unknown field ''extra''' ELSE '' END AS why
    FROM events
""")
def strict_json(spark, sf_dir):
    """S3: JSON objects with planted unknown fields and broken text."""
    extra = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "extra": 1}'))
    text = F.when(F.col("event_id") % 17 == 5, F.lit("{k: ")).when(F.col("event_id") % 13 == 4, extra).otherwise(F.col("props"))
    records = table(spark, sf_dir, "events").select("event_id", text.alias("line"))
    target = spec(("k", "Nullable(Int32)"))
    parsed = read_json_strict(records, "line", target, keep=["event_id"])
    done = conform(parsed.withColumnRenamed(ERRORS, "_parse"), target, keep=["event_id", "_parse"])
    return done.select("event_id", "k", F.array_join("_parse", "; ").alias("why"))


@registry.add("""
    WITH ahead AS (SELECT * FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-15'))
    SELECT event_id, user_id, event_type FROM ahead ORDER BY event_id LIMIT 1000
""")
def incremental_pull(spark, sf_dir):
    """The next 1000 events after those of the first half month."""
    events = table(spark, sf_dir, "events")
    loaded = events.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    return pull_increment(events, loaded, "event_id", 1000).select("event_id", "user_id", "event_type")


@registry.add("""
    SELECT event_type, count(*) AS n, sum(CASE WHEN event_id % 19 = 7 THEN 0 ELSE 1 END)::BIGINT AS readable,
           sum(CASE WHEN event_id % 19 = 7 THEN 0 ELSE event_id END)::BIGINT AS ids
    FROM events GROUP BY event_type
""")
def corrupt_rows(spark, sf_dir):
    """JSON lines with planted junk."""
    path = Scratch(spark).path("lines")
    line = F.to_json(F.struct("event_id", "event_type"))
    events = table(spark, sf_dir, "events")
    events.select("event_type", F.when(F.col("event_id") % 19 == 7, F.concat(F.lit("<<"), line)).otherwise(line).alias("value")).write.partitionBy(
        "event_type"
    ).text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType())])
    good, bad = read_checked(spark, f"{path}/*", "json", schema)
    kind = F.regexp_extract(F.col("raw"), '"event_type":"([a-z]+)"', 1)
    good = read_checked(spark, f"{path}/*", "json", T.StructType([*schema, T.StructField("event_type", T.StringType())]))[0]
    rows = good.select("event_type", "event_id", F.lit(1).alias("ok")).unionByName(
        bad.select(kind.alias("event_type"), F.lit(0).cast("bigint").alias("event_id"), F.lit(0).alias("ok"))
    )
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("ok").alias("readable"), F.sum("event_id").alias("ids"))


@registry.add(f"""
    WITH numbered AS (SELECT l_orderkey, l_partkey, row_number() OVER (ORDER BY {_SQL_ORDER}) - 1 AS i FROM lineitem)
    SELECT i // 1000 AS batch_index, CASE WHEN i // 1000 = 0 THEN 'load-42' ELSE 'load-42-' || (i // 1000) END AS batch_token,
           count(*) AS n, sum(l_orderkey)::BIGINT AS orders, sum(l_partkey)::BIGINT AS parts, min(l_orderkey) AS first_order, max(l_orderkey) AS last_order
    FROM numbered GROUP BY i // 1000
""")
def batch_cut(spark, sf_dir):
    """K1, K2: one load in batches of 1000 rows over a total order."""
    lines = table(spark, sf_dir, "lineitem").withColumn("load", F.lit("load-42"))
    cut = cut_batches(lines, LINE_ORDER, 1000).withColumn("batch_token", batch_token(F.col("load"), F.col("batch_index")))
    return cut.groupBy("batch_index", "batch_token").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("orders"), F.sum("l_partkey").alias("parts"),
        F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order"),
    )


@registry.add(f"""
    WITH numbered AS (
        SELECT l_suppkey, l_orderkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY {_SQL_ORDER}) - 1 AS i FROM lineitem)
    SELECT l_suppkey::VARCHAR AS load_id, i // 50 AS batch_index,
           CASE WHEN i // 50 = 0 THEN l_suppkey::VARCHAR ELSE l_suppkey || '-' || (i // 50) END AS batch_token,
           count(*) AS n, sum(l_orderkey)::BIGINT AS orders
    FROM numbered GROUP BY l_suppkey, i // 50
""")
def batch_cut_by_load(spark, sf_dir):
    """K1, K2: many loads, each cut on its own."""
    lines = table(spark, sf_dir, "lineitem").withColumn("load_id", F.col("l_suppkey").cast("string"))
    cut = cut_batches(lines, LINE_ORDER, 50, "load_id", "load_id")
    return cut.groupBy("load_id", "batch_index", "batch_token").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("orders"))


@registry.add("""
    SELECT event_id, 'u' || user_id AS by_load, CASE WHEN event_id % 7 = 2 THEN NULL ELSE event_type END AS by_column,
           CASE WHEN event_id % 7 IN (2, 3) THEN 'token column ''tag'' is missing or empty' END AS why
    FROM (SELECT event_id, user_id, CASE WHEN event_id % 7 = 3 THEN '  ' ELSE event_type END AS event_type FROM events)
""")
def token_modes(spark, sf_dir):
    """K3: tokens from the load id or from a column, which may be missing or blank."""
    tag = F.when(F.col("event_id") % 7 == 2, F.lit(None)).when(F.col("event_id") % 7 == 3, F.lit("  ")).otherwise(F.col("event_type"))
    events = table(spark, sf_dir, "events").withColumn("load_id", F.concat(F.lit("u"), F.col("user_id"))).withColumn("tag", tag)
    return events.select("event_id", base_token("load_id").alias("by_load"), base_token("tag").alias("by_column"), token_error("tag").alias("why"))


def _bad_lines(spark, sf_dir):
    """Line items as loads per supplier, cut in batches of 50, with planted bad quantities."""
    quantity = F.when(F.col("l_orderkey") % 997 == 3, F.lit("many")).otherwise(F.col("l_quantity").cast("string"))
    keep = [c for c in LINE_ORDER if c != "l_quantity"]
    lines = table(spark, sf_dir, "lineitem").withColumn("amount", quantity).withColumn("sort_quantity", F.col("l_quantity"))
    rows = conform(lines, spec(("amount", "Decimal(9, 2)")), keep=[*keep, "sort_quantity"])
    order = [c if c != "l_quantity" else "sort_quantity" for c in LINE_ORDER]
    # both sides and the search for bad rows read the cut rows back
    return Scratch(spark).keep(cut_batches(rows.withColumn("load_id", F.col("l_suppkey")), order, 50, "load_id"), "cut")


_BAD_CTE = f"""
    WITH numbered AS (
        SELECT *, (row_number() OVER (PARTITION BY l_suppkey ORDER BY {_SQL_ORDER}) - 1) // 50 AS batch_index,
               l_orderkey % 997 = 3 AS bad FROM lineitem),
    first_bad AS (SELECT l_suppkey AS s, min(batch_index) AS b FROM numbered WHERE bad GROUP BY l_suppkey)
"""


@registry.add(_BAD_CTE + """
    SELECT l_suppkey AS load_id, CASE WHEN b IS NULL OR batch_index < b THEN 'accepted' ELSE 'rejected' END AS side,
           count(*) AS n, sum(l_orderkey)::BIGINT AS orders, max(batch_index) AS last_batch
    FROM numbered LEFT JOIN first_bad ON l_suppkey = s GROUP BY 1, 2
""")
def route_prefix(spark, sf_dir):
    """K7: the batches before the first bad one stay."""
    return _sides(route(_bad_lines(spark, sf_dir), "prefix"))


@registry.add(_BAD_CTE + """
    SELECT l_suppkey AS load_id, CASE WHEN b IS NULL THEN 'accepted' ELSE 'rejected' END AS side,
           count(*) AS n, sum(l_orderkey)::BIGINT AS orders, max(batch_index) AS last_batch
    FROM numbered LEFT JOIN first_bad ON l_suppkey = s GROUP BY 1, 2
""")
def route_load(spark, sf_dir):
    """K8: one bad row keeps its load out."""
    return _sides(route(_bad_lines(spark, sf_dir), "load"))


@registry.add(_BAD_CTE + """
    SELECT l_suppkey AS load_id, CASE WHEN bad THEN 'rejected' ELSE 'accepted' END AS side,
           count(*) AS n, sum(l_orderkey)::BIGINT AS orders, max(batch_index) AS last_batch
    FROM numbered GROUP BY 1, 2
""")
def route_row(spark, sf_dir):
    """Each row on its own."""
    return _sides(route(_bad_lines(spark, sf_dir), "row"))


def _sides(pair):
    rows = [df.select("load_id", F.lit(side).alias("side"), "l_orderkey", "batch_index") for df, side in zip(pair, ("accepted", "rejected"), strict=True)]
    both = rows[0].unionByName(rows[1])
    return both.groupBy("load_id", "side").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("orders"), F.max("batch_index").alias("last_batch")
    )


def _arrivals(spark, sf_dir):
    """Every event as a batch that arrives for the table of its type, under the token of its user."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table"), F.col("event_id").alias("seq"), F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("token")
    )


def _history(spark, sf_dir):
    """A ledger that accepted a batch for every third part of each brand's number, newest last."""
    orders = table(spark, sf_dir, "orders")
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("view", "signup", "error", "click", "purchase")]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return orders.select(
        (F.col("o_orderkey") - 10_000_000).alias("seq"), kinds.alias("table"), F.lit("old").alias("load_id"),
        F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("token"), F.lit(0).cast("bigint").alias("batch_index"),
        F.lit(1).cast("bigint").alias("rows"), F.when(F.col("o_orderkey") % 3 == 0, L.ACCEPTED).otherwise(L.FAILED).alias("status"),
    )


_HISTORY_SQL = """
    SELECT o_orderkey - 10000000 AS seq, ['view', 'signup', 'error', 'click', 'purchase'][o_orderkey % 5 + 1] AS tab, 't' || o_custkey AS token
    FROM orders WHERE o_orderkey % 3 = 0
"""


@registry.add(f"""
    WITH ranked AS (SELECT tab, token, row_number() OVER (PARTITION BY tab ORDER BY seq DESC) AS age FROM ({_HISTORY_SQL}))
    SELECT tab AS "table", token, age::INT AS age FROM ranked WHERE age <= 200
""")
def dedup_window(spark, sf_dir):
    """K5: the 200 tokens of each table that still count."""
    return L.recent_tokens(_history(spark, sf_dir), 200)


@registry.add(f"""
    WITH arrivals AS (
        SELECT event_type AS tab, event_id AS seq, 't' || user_id AS token,
               row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS nth FROM events),
    known AS (SELECT DISTINCT tab, token FROM ({_HISTORY_SQL}))
    SELECT tab AS "table", seq, token, nth = 1 AND k.token IS NULL AS accepted
    FROM arrivals LEFT JOIN known k USING (tab, token)
""")
def dedup_ledger(spark, sf_dir):
    """K4: replayed tokens dropped."""
    return L.dedup(_arrivals(spark, sf_dir), _history(spark, sf_dir))


@registry.add(f"""
    WITH arrivals AS (
        SELECT event_type AS tab, event_id AS seq, 't' || user_id AS token,
               row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS nth FROM events),
    known AS (
        SELECT DISTINCT tab, token FROM (
            SELECT tab, token, row_number() OVER (PARTITION BY tab ORDER BY seq DESC) AS age FROM ({_HISTORY_SQL})) WHERE age <= 40)
    SELECT tab AS "table", seq, token, nth = 1 AND k.token IS NULL AS accepted
    FROM arrivals LEFT JOIN known k USING (tab, token)
""")
def dedup_replay(spark, sf_dir):
    """K5: the same when only the 40 newest accepted tokens of a table count."""
    return L.dedup(_arrivals(spark, sf_dir), _history(spark, sf_dir), window=40)


@registry.add("""
    SELECT 'user-' || user_id AS load_id, 2 * count(*)::BIGINT AS rows_written, 2 * ceil(count(*) / 20)::BIGINT AS inserts,
           ceil(count(*) / 20)::BIGINT AS duplicates, count(*)::BIGINT AS rows_in_table, sum(event_id)::BIGINT AS ids
    FROM events GROUP BY user_id
""")
def load_summary(spark, sf_dir):
    """K4, K6: the whole load path run twice; the second run reports its rows and writes none."""
    scratch = Scratch(spark)
    path, book = scratch.path("target"), scratch.path("ledger")
    target = spec(("event_id", "UInt64"), ("ts", "DateTime64(6)"), ("user_id", "UInt32"), ("event_type", "LowCardinality(String)"), ("value", "Decimal(18, 4)"))
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("load_id"),
        F.col("event_id").cast("string").alias("event_id"), "ts", "user_id", "event_type", F.col("value").cast("string").alias("value"),
    )
    for _ in range(2):
        load(events, path, target, book, order_by=["event_id"], max_rows=20).close()
    written = read_target(spark, path, target).withColumn("load_id", F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    present = written.groupBy("load_id").agg(F.count(F.lit(1)).alias("rows_in_table"), F.sum(F.col("event_id").cast("bigint")).alias("ids"))
    return L.load_summary(L.read_ledger(spark, book)).join(present, "load_id")


@registry.add("""
    SELECT 'load' AS unit, count(*) AS rows_in_table, sum(l_orderkey)::BIGINT AS orders FROM lineitem
    WHERE l_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_orderkey % 4999 = 3)
    UNION ALL SELECT 'row', count(*), sum(l_orderkey)::BIGINT FROM lineitem WHERE l_orderkey % 4999 <> 3
""")
def load_units(spark, sf_dir):
    """K8, P8 through the load path: what reaches the table when some rows cannot be converted."""
    scratch = Scratch(spark)
    target = spec(("l_orderkey", "UInt64"), ("l_quantity", "Decimal(9, 2)"))
    quantity = F.when(F.col("l_orderkey") % 4999 == 3, F.lit("?")).otherwise(F.col("l_quantity").cast("string"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", quantity.alias("l_quantity"), F.col("l_suppkey").cast("string").alias("load_id"))
    out = None
    for unit in ("load", "row"):
        path = scratch.path(unit)
        load(lines, path, target, scratch.path("ledger"), order_by=["l_orderkey"], unit=unit, max_rows=500).close()
        part = read_target(spark, path).agg(F.count(F.lit(1)).alias("rows_in_table"), F.sum(F.col("l_orderkey").cast("bigint")).alias("orders"))
        part = part.select(F.lit(unit).alias("unit"), "rows_in_table", "orders")
        out = part if out is None else out.unionByName(part)
    return out


def _failures(spark, sf_dir):
    """A ledger with a failure chain per event."""
    cause = lambda kind, code, message: F.struct(
        F.lit(kind).alias("kind"), F.lit(code).cast("int").alias("code"), (message if not isinstance(message, str) else F.lit(message)).alias("message")
    )
    nobody = F.lit(None).cast("string")
    chain = (
        F.when(F.col("event_type") == "view", F.array(cause("client", None, "Failed to get query response"), cause("transport", None, "reset")))
        .when(F.col("event_type") == "click", F.array(cause("client", None, "insert failed: Too many parts"), cause("server", 252, "Too many parts")))
        .when(F.col("event_type") == "signup", F.array(cause("wrapper", None, nobody), cause("server", 60, "Table not found"), cause("transport", None, "closed")))
        .when(F.col("event_type") == "purchase", F.array(cause("IllegalStateException", None, nobody)))
        .otherwise(F.array().cast(f"array<{L.CAUSE}>"))
    )
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").alias("seq"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("load_id"), "event_type",
        F.when(F.col("event_type").isin("view", "click"), L.RETRY).when(F.col("event_type") == "error", L.ACCEPTED).otherwise(L.FAILED).alias("status"),
        (F.col("event_id") % 12).cast("int").alias("attempts"), chain.alias("causes"),
    )


@registry.add("""
    SELECT event_id AS seq, event_type IN ('view', 'click') AS retryable, event_type IN ('click', 'signup') AS server_error FROM events
""")
def classify_errors(spark, sf_dir):
    return L.classify(_failures(spark, sf_dir)).select("seq", "retryable", "server_error")


@registry.add("""
    SELECT event_id AS seq, CASE event_type WHEN 'view' THEN 'Failed to get query response: reset' WHEN 'click' THEN 'insert failed: Too many parts'
                                 WHEN 'signup' THEN 'wrapper: closed' WHEN 'purchase' THEN 'IllegalStateException' END AS error
    FROM events
""")
def error_message(spark, sf_dir):
    return L.error_message(_failures(spark, sf_dir)).select("seq", "error")


@registry.add("""
    WITH state AS (
        SELECT 'u' || user_id AS load_id, arg_max(event_type, event_id) AS last_type, max(event_id % 12) AS attempts FROM events GROUP BY user_id),
    due AS (SELECT load_id FROM state WHERE last_type IN ('view', 'click') AND attempts < 12)
    SELECT o_orderkey, 'u' || o_custkey AS load_id FROM orders WHERE 'u' || o_custkey IN (SELECT load_id FROM due)
""")
def retry_select(spark, sf_dir):
    """pending rows whose load is due again."""
    pending = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("load_id"))
    return L.retry_select(pending, _failures(spark, sf_dir), max_attempts=12)


_PENDING_FILES = 12


@registry.add(f"""
    SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids, {_PENDING_FILES}::BIGINT AS units,
           true AS few_writes, 0::BIGINT AS waiting
    FROM events GROUP BY event_type
""")
def stream_pending(spark, sf_dir):
    """A file a micro-batch, loaded by rows: five or more units a write, the rest at the end, each under a token."""
    scratch = Scratch(spark)
    inbox, path, book = scratch.path("inbox"), scratch.path("target"), scratch.path("ledger")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    numbered = events.withColumn("k", F.col("event_id") % _PENDING_FILES)
    numbered.repartition(_PENDING_FILES, "k").write.partitionBy("k").parquet(inbox)
    least = numbered.groupBy("k").count().agg(F.max("count")).first()[0] * 5
    units = []
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(inbox)
    target = spec(("event_id", "Int64"), ("event_type", "String"))
    query = stream_load(
        stream, path, target, book, scratch.path("checkpoint"), "events", pending_path=scratch.path("pending"), pending_rows=least, pending_age=3600.0, on_batch=lambda _, last: units.append(last),
    )
    query.awaitTermination()
    pending = pending_units(query)
    pending.flush()
    loads = L.read_ledger(spark, book).select("load_id").distinct().count()
    rows = read_target(spark, path, target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
    return rows.select(
        "event_type", "n", "ids", F.lit(units[-1] + 1).cast("bigint").alias("units"), F.lit(loads == len(units) and loads <= 3).alias("few_writes"),
        F.lit(len(pending.units())).cast("bigint").alias("waiting"),
    )


@registry.add("""
    SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids, sum(user_id)::BIGINT AS users
    FROM events GROUP BY event_type
""")
def stream_load_events(spark, sf_dir):
    """The events as a stream of files, loaded by micro-batches until nothing is left."""
    scratch = Scratch(spark)
    inbox, path = scratch.path("inbox"), scratch.path("target")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    events.repartition(3, "user_id").write.parquet(inbox)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    target = spec(("event_id", "Int64"), ("ts", "DateTime64(6)"), ("user_id", "UInt32"), ("event_type", "String"))
    query = stream_load(stream, path, target, scratch.path("ledger"), scratch.path("checkpoint"), "events", max_rows=1000)
    query.awaitTermination()
    rows = read_target(spark, path, target)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.sum("user_id").alias("users"))


@registry.add("""
    SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type
""")
def stream_drop_replayed(spark, sf_dir):
    """R2: every event arrives twice; the second arrival is dropped within the horizon."""
    scratch = Scratch(spark)
    inbox, path = scratch.path("inbox"), scratch.path("target")
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.unionByName(events).repartition(2, "event_id").write.parquet(inbox)
    stream = spark.readStream.schema(events.schema).parquet(inbox)
    once = drop_replayed(stream, ["event_id"], "ts", "40 days")
    query = once.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch.path("checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(events.schema).parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@registry.add("""
    SELECT 'accepted' AS side, count(*) AS n, 0::BIGINT AS bad FROM events WHERE event_id % 101 <> 7
    UNION ALL SELECT 'rejected', count(*), count(*) FROM events WHERE event_id % 101 = 7
""")
def stream_rejects(spark, sf_dir):
    """A stream with planted bad rows, in the default unit: what was loaded and what was handed back make up the input."""
    scratch = Scratch(spark)
    inbox, path, back = scratch.path("inbox"), scratch.path("target"), scratch.path("rejected")
    user = F.when(F.col("event_id") % 101 == 7, F.lit("nobody")).otherwise(F.col("user_id").cast("string"))
    events = table(spark, sf_dir, "events").select("event_id", user.alias("user_id"))
    events.repartition(3, "event_id").write.parquet(inbox)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    target = spec(("event_id", "Int64"), ("user_id", "UInt32"))
    stream_load(stream, path, target, scratch.path("ledger"), scratch.path("checkpoint"), "events", rejected_path=back).awaitTermination()
    sides = read_target(spark, path, target).select(F.lit("accepted").alias("side"), F.lit(0).alias("bad"))
    sides = sides.unionByName(spark.read.parquet(back).select(F.lit("rejected").alias("side"), (F.size(ERRORS) > 0).cast("int").alias("bad")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))


@registry.add("""
    SELECT count(*) AS n, sum(event_id)::BIGINT AS ids, ceil(count(*) / 20)::BIGINT AS inserts, ceil(count(*) / 20)::BIGINT AS duplicates FROM events
""")
def load_replay_many_batches(spark, sf_dir):
    """K4, K5: one load of more batches than a table's usual window, twice; the second adds nothing."""
    scratch = Scratch(spark)
    path, book = scratch.path("target"), scratch.path("ledger")
    target = spec(("event_id", "UInt64"), ("user_id", "UInt32"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    for _ in range(2):
        done = load(events, path, target, book, load_id="all", max_rows=20)
        done.close()
    return read_target(spark, path, target).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("event_id").cast("bigint")).alias("ids")).select(
        "n", "ids", F.lit(done.inserts).cast("bigint").alias("inserts"), F.lit(done.duplicate_inserts).cast("bigint").alias("duplicates")
    )


@registry.add("""
    SELECT step, n, ids FROM (
        SELECT 1 AS step, count(*) AS n, sum(o_orderkey)::BIGINT AS ids FROM orders
        UNION ALL SELECT 2, count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_orderkey % 3 <> 1
        UNION ALL SELECT 3, count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_orderkey % 3 <> 1 AND o_orderkey % 5 = 2)
""")
def table_life(spark, sf_dir):
    """Create, load by name (twice under one id), delete, add a column with a default, update, count."""
    scratch = Scratch(spark)
    name, book = f"life_{scratch.root[-32:]}", scratch.path("ledger")
    S.create_table(spark, name, [ColumnSpec("o_orderkey", "UInt32"), ColumnSpec("note", "String", default="'none'")], path=scratch.path("table"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"))
    for _ in range(2):
        load_table(orders, name, book, load_id="orders").close()
    rows = lambda step, df: df.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("bigint").alias("ids")).select(F.lit(step).alias("step"), "n", "ids")
    one = scratch.keep(rows(1, spark.table(name).where("note = 'none'")), "one")
    S.delete_where(spark, name, "o_orderkey % 3 = 1")
    two = scratch.keep(rows(2, spark.table(name)), "two")
    S.add_columns(spark, name, [ColumnSpec("mark", "Int32", default="1")])
    S.update_where(spark, name, "o_orderkey % 5 = 2", {"mark": "2"})
    three = scratch.keep(rows(3, spark.table(name).where("mark = 2")), "three")
    S.drop(spark, name)
    return one.unionByName(two).unionByName(three)


@registry.add("""
    SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
""")
def csv_headers(spark, sf_dir):
    """Two files with the same fields in another order, read by name."""
    path = Scratch(spark).path("csv")
    orders = table(spark, sf_dir, "orders")
    for k, order in enumerate((["o_orderkey", "o_custkey", "o_orderpriority"], ["o_orderpriority", "o_custkey", "o_orderkey"])):
        orders.where(F.col("o_orderkey") % 2 == k).select(*order).coalesce(1).write.mode("append").option("header", True).csv(path)
    records = read_records(spark, path, "csv", by_header=True)
    return conform(records, spec(("o_orderkey", "Int64"), ("o_custkey", "Int64"), ("o_orderpriority", "String"))).drop(ERRORS).select("o_orderkey", "o_custkey", "o_orderpriority")


@registry.add("""
    SELECT o_orderkey, 'say "' || o_orderpriority || '", he' || chr(10) || 'said' AS words FROM orders
""")
def csv_quotes(spark, sf_dir):
    """Doubled quotes, commas and line breaks inside quotes."""
    path = Scratch(spark).path("csv")
    words = F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", he\nsaid'))
    table(spark, sf_dir, "orders").select("o_orderkey", words.alias("words")).write.option("header", True).option("escape", '"').csv(path)
    records = read_records(spark, path, "csv", multi_line=True)
    return conform(records, spec(("o_orderkey", "Int64"), ("words", "String"))).drop(ERRORS)


@registry.add("""
    SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type
""")
def stream_buffered(spark, sf_dir):
    """Many small files gathered over a time into few writes, without a token."""
    scratch = Scratch(spark)
    inbox, path = scratch.path("inbox"), scratch.path("target")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    events.repartition(6, "event_id").write.parquet(inbox)
    stream = spark.readStream.schema(events.schema).parquet(inbox)
    target = spec(("event_id", "Int64"), ("event_type", "String"))
    query = stream_load(stream, path, target, scratch.path("ledger"), scratch.path("checkpoint"), "events", token="none", buffer="1 second", rejected_path=scratch.path("rejected"))
    query.processAllAvailable()
    query.stop()
    return read_target(spark, path, target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
