"""Registered queries: many calls, several writers, partitioned targets, files as units, failing control queries."""

from __future__ import annotations

from pyspark import InheritableThread
from pyspark.sql import functions as F

from quayside.operators import ledger as L
from quayside.operators import statements as S
from quayside.operators.export import export, read_export
from quayside.operators.load import load, load_table, read_target
from quayside.operators.queries import outcomes, read_results, run_each
from quayside.operators.retry import run_loads
from quayside.plans.session import Scratch
from quayside.plans.storage import Storage
from quayside.plans.tables import Registry, table
from quayside.sources.readers import note_pulled, pull_increment, pulled_to, read_units
from quayside.types import ColumnSpec, spec

registry = Registry()

_ORDERS = spec(("o_orderkey", "UInt64"), ("o_custkey", "UInt32"), ("o_totalprice", "Decimal(18, 2)"))
CALLS = 12


def _texts(df, *names):
    return df.select(*[F.col(n).cast("string").alias(n) for n in names])


@registry.add(f"""
    SELECT 'call-' || k AS load_id, count(o_orderkey) AS in_table, count(o_orderkey) * (CASE WHEN k < 2 THEN 2 ELSE 1 END) AS rows_written,
           ceil(count(o_orderkey) / 100)::BIGINT * (CASE WHEN k < 2 THEN 2 ELSE 1 END) AS inserts,
           CASE WHEN k < 2 THEN ceil(count(o_orderkey) / 100)::BIGINT ELSE 0 END AS duplicates, sum(o_custkey)::BIGINT AS customers
    FROM range({CALLS}) t(k) LEFT JOIN orders ON o_orderkey % {CALLS} = k GROUP BY k
""")
def load_many_calls(spark, sf_dir):
    """A table filled by many calls, two of them repeated at the end; the ledger's log is merged on the way."""
    scratch = Scratch(spark)
    path, book = scratch.path("target"), scratch.path("ledger")
    orders = table(spark, sf_dir, "orders")
    for k in [*range(CALLS), 0, 1]:
        some = _texts(orders.where(F.col("o_orderkey") % CALLS == k), "o_orderkey", "o_custkey", "o_totalprice")
        load(some, path, _ORDERS, book, load_id=f"call-{k}", max_rows=100).close()
    told = L.load_summary(L.read_ledger(spark, book))
    rows = read_target(spark, path, _ORDERS).groupBy(F.concat(F.lit("call-"), F.col("o_orderkey") % CALLS).alias("load_id"))
    return rows.agg(F.count(F.lit(1)).alias("in_table"), F.sum(F.col("o_custkey").cast("bigint")).alias("customers")).join(told, "load_id")


@registry.add("""
    SELECT w::VARCHAR AS writer, count(*) AS n, sum(o_orderkey)::BIGINT AS ids, count(*) > 0 AS all_in FROM orders, LATERAL (SELECT o_orderkey % 4 AS w) GROUP BY w
    UNION ALL SELECT 'ledger', count(*), sum(o_orderkey)::BIGINT, true FROM orders
""")
def load_concurrent(spark, sf_dir):
    """K4, K8: four writers at once on one table, each load tried by two of them; no row is lost or doubled."""
    scratch = Scratch(spark)
    path, book = scratch.path("target"), scratch.path("ledger")
    orders = table(spark, sf_dir, "orders")

    def write(k: int) -> tuple[int, int]:
        some = _texts(orders.where(F.col("o_orderkey") % 4 == k % 4), "o_orderkey", "o_custkey", "o_totalprice")
        done = load(some, path, _ORDERS, book, load_id=f"writer-{k % 4}", max_rows=500)
        done.close()
        return done.inserts - done.duplicate_inserts, done.rows_written

    _at_once(write, range(8))
    rows = read_target(spark, path, _ORDERS)
    by = rows.groupBy((F.col("o_orderkey") % 4).cast("string").alias("writer")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("bigint").alias("ids"))
    told = L.read_ledger(spark, book).where(F.col("status") == L.ACCEPTED).agg(F.sum("rows").alias("n"), F.count_distinct("seq").alias("a"), F.count(F.lit(1)).alias("b"))
    ids = rows.agg(F.sum("o_orderkey").cast("bigint")).first()[0]
    total = told.select(F.lit("ledger").alias("writer"), "n", F.lit(ids).cast("bigint").alias("ids"), (F.col("a") == F.col("b")).alias("all_in"))
    return by.withColumn("all_in", F.lit(True)).unionByName(total)


def _at_once(work, items) -> list:
    """``work`` on every item at the same time, each thread with the session's own settings."""
    out: dict = {}

    def run(item):
        out[item] = work(item)

    failed: list[BaseException] = []

    def guarded(item):
        try:
            run(item)
        except BaseException as error:  # noqa: BLE001  raised again below, in the caller's thread
            failed.append(error)

    threads = [InheritableThread(target=guarded, args=(i,)) for i in items]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failed:
        raise failed[0]
    return [out[i] for i in items]


@registry.add("""
    SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids, sum(user_id)::BIGINT AS users, 'new' AS note FROM events GROUP BY event_type
""")
def load_partitioned(spark, sf_dir):
    """Loads by name into a table with partitions, old and new ones, and one load twice."""
    scratch = Scratch(spark)
    name, book = f"parted_{scratch.root[-32:]}", scratch.path("ledger")
    columns = [ColumnSpec("event_id", "UInt64"), ColumnSpec("user_id", "UInt32"), ColumnSpec("note", "String", default="'new'"), ColumnSpec("event_type", "String")]
    S.create_table(spark, name, columns, partition_by=["event_type"], path=scratch.path("table"))
    events = table(spark, sf_dir, "events")
    first = F.col("event_type").isin("view", "click") & (F.col("event_id") % 2 == 0)
    for load_id, some in (("first", events.where(first)), ("rest", events.where(~first)), ("first", events.where(first))):
        load_table(_texts(some, "event_id", "user_id", "event_type"), name, book, load_id=load_id).close()
    found = spark.table(name).groupBy("event_type", "note").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("bigint").alias("ids"), F.sum(F.col("user_id").cast("bigint")).alias("users")
    )
    found = scratch.keep(found, "found")
    S.drop(spark, name)
    return found


@registry.add("""
    SELECT 'in' AS fate, 'part-' || k AS unit, count(*) AS n, sum(event_id)::BIGINT AS ids, 0 AS bad FROM (SELECT *, event_id % 3 AS k FROM events) WHERE k <> 1 GROUP BY k
    UNION ALL SELECT 'back', 'part-1', count(*) + 1, sum(event_id)::BIGINT, 1 FROM events WHERE event_id % 3 = 1
""")
def load_corrupt(spark, sf_dir):
    """Three files, a broken line in one of them: two go in, the third comes back whole with the parse error."""
    scratch = Scratch(spark)
    folder, path, book = scratch.path("json"), scratch.path("target"), scratch.path("ledger")
    events, target = table(spark, sf_dir, "events").select("event_id", "user_id"), spec(("event_id", "UInt64"), ("user_id", "UInt32"))
    for k in range(3):
        lines = events.where(F.col("event_id") % 3 == k).select(F.to_json(F.struct("event_id", "user_id")).alias("line"))
        if k == 1:
            lines = lines.unionByName(spark.range(1).select(F.lit('{"event_id": 1, "user_id"').alias("line")))
        lines.coalesce(1).write.text(f"{folder}/part-{k}")
    unit = F.regexp_extract("load_id", "(part-[0-9])/", 1)
    records = read_units(spark, f"{folder}/*", "json", target).withColumn("load_id", unit)
    done = load(records, path, target, book, order_by=["event_id"])
    told = F.count(F.when(F.size("_errors") > 0, 1)).cast("int").alias("bad")
    went = read_target(spark, path, target).groupBy(F.concat(F.lit("part-"), F.col("event_id") % 3).alias("unit")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("bigint").alias("ids"), F.lit(0).alias("bad")
    )
    good = F.when(F.size("_errors") == 0, F.col("event_id"))
    back = done.rejected.groupBy(F.col("load_id").alias("unit")).agg(F.count(F.lit(1)).alias("n"), F.sum(good).cast("bigint").alias("ids"), told)
    return went.select(F.lit("in").alias("fate"), "*").unionByName(back.select(F.lit("back").alias("fate"), "*"))


@registry.add("""
    SELECT 'file-' || k AS file, count(*) AS n, sum(o_orderkey)::BIGINT AS ids, sum(CASE WHEN k = 2 THEN 0 ELSE o_custkey END)::BIGINT AS customers,
           ceil(count(*) / 500)::BIGINT AS inserts, ceil(count(*) / 500)::BIGINT AS duplicates
    FROM (SELECT *, o_orderkey % 3 AS k FROM orders) GROUP BY k
""")
def load_by_file(spark, sf_dir):
    """Each file is a unit under its own header, its name the token; the second run adds nothing."""
    scratch = Scratch(spark)
    folder, path, book = scratch.path("csv"), scratch.path("target"), scratch.path("ledger")
    orders, target = table(spark, sf_dir, "orders"), spec(("o_orderkey", "UInt64"), ("o_custkey", "UInt32"), ("kind", "String"))
    headers = (["o_orderkey", "o_custkey", "kind"], ["kind", "o_orderkey", "o_custkey"], ["kind", "o_orderkey"])
    for k, fields in enumerate(headers):
        some = orders.where(F.col("o_orderkey") % 3 == k).withColumn("kind", F.lit(f"file-{k}"))
        some.select(*fields).coalesce(1).write.option("header", True).csv(f"{folder}/file-{k}")
    records = read_units(spark, f"{folder}/*", "csv", target, by_header=True).withColumn("load_id", F.regexp_extract("load_id", "(file-[0-9])/", 1))
    for _ in range(2):
        done = load(records, path, target, book, order_by=["o_orderkey"], max_rows=500)
        told = L.load_summary(done.batches).select(F.col("load_id").alias("file"), "inserts", "duplicates")
    rows = read_target(spark, path, target).groupBy(F.col("kind").alias("file"))
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("bigint").alias("ids"), F.sum(F.col("o_custkey").cast("bigint")).alias("customers"))
    return found.join(told, "file")


@registry.add("""
    SELECT c_nationkey AS nation, CASE WHEN c_nationkey % 5 = 3 THEN 'failed' WHEN c_nationkey % 5 = 4 THEN 'no query' ELSE 'ran' END AS fate,
           CASE WHEN c_nationkey % 5 < 3 THEN count(*) ELSE 0 END AS n, CASE WHEN c_nationkey % 5 < 3 THEN sum(c_custkey)::BIGINT ELSE 0 END AS ids
    FROM customer GROUP BY c_nationkey
""")
def control_failures(spark, sf_dir):
    """A query per control row as jobs of its own; those that divide by zero at some row fail alone."""
    scratch = Scratch(spark)
    into = scratch.path("results")
    customer = table(spark, sf_dir, "customer")
    customer.createOrReplaceTempView(f"customer_{scratch.root[-32:]}")
    good = f"SELECT c_custkey FROM customer_{scratch.root[-32:]} WHERE c_nationkey = :nation"
    bad = f"SELECT assert_true(c_custkey < 0, 'no such customer') AS c_custkey FROM customer_{scratch.root[-32:]} WHERE c_nationkey = :nation"
    fate = F.pmod(F.col("nation"), F.lit(5))
    control = customer.select(F.col("c_nationkey").alias("nation")).distinct().withColumn("sql", F.when(fate == 3, F.lit(bad)).when(fate == 4, F.lit(" ")).otherwise(F.lit(good)))
    found = outcomes(spark, control, list(run_each(spark, control, into, args=["nation"], keep=["nation"])))
    sums = read_results(spark, into).groupBy(F.col("nation").alias("of")).agg(F.count(F.lit(1)).alias("got"), F.sum("c_custkey").cast("bigint").alias("ids"))
    said = F.when(F.col("error").isNull() & (F.col("rows") == F.coalesce("got", F.lit(0))), "ran").when(F.col("error") == "no SQL query", "no query").otherwise("failed")
    joined = found.join(sums, F.col("nation") == F.col("of"), "left")
    return joined.select("nation", said.alias("fate"), F.coalesce("got", F.lit(0)).alias("n"), F.coalesce("ids", F.lit(0)).alias("ids"))


@registry.add("""
    SELECT 'load-' || k AS load_id, CASE k WHEN 2 THEN 'retry' WHEN 3 THEN 'failed' ELSE 'accepted' END AS status, CASE k WHEN 1 THEN 3 WHEN 2 THEN 4 ELSE 1 END AS attempts,
           CASE WHEN k IN (2, 3) THEN 0 ELSE count(*) END AS n, k IN (2, 3) AS handed_back
    FROM (SELECT c_nationkey % 5 AS k FROM customer) GROUP BY k
""")
def retry_real(spark, sf_dir):
    """five loads; the source of one resets the connection twice, of one always, of one it is refused: tried again, at most four times."""
    scratch = Scratch(spark)
    path, book, customer = scratch.path("target"), scratch.path("ledger"), table(spark, sf_dir, "customer")
    faults = {"load-1": [ConnectionResetError("reset by peer")] * 2, "load-2": [ConnectionResetError("reset by peer")] * 9, "load-3": [PermissionError("not allowed")]}
    target = spec(("c_custkey", "UInt32"), ("k", "UInt8"))

    def attempt(load_id: str):
        waiting = faults.get(load_id)
        if waiting:
            raise waiting.pop()
        some = customer.select("c_custkey", (F.col("c_nationkey") % 5).alias("k")).where(F.concat(F.lit("load-"), F.col("k")) == load_id)
        return load(some, path, target, book, load_id=load_id, table="customers")

    back = run_loads(spark, book, "customers", attempt, [f"load-{k}" for k in range(5)], max_attempts=4, pause=lambda _: 0)
    mine = L.read_ledger(spark, book).groupBy("load_id").agg(F.max_by("status", "seq").alias("status"), F.max("attempts").alias("attempts"))
    rows = read_target(spark, path, target).groupBy(F.concat(F.lit("load-"), F.col("k")).alias("load_id")).agg(F.count(F.lit(1)).alias("n"))
    handed = back.select("load_id", F.lit(True).alias("back"))
    joined = mine.join(rows, "load_id", "left").join(handed, "load_id", "left")
    return joined.select("load_id", "status", "attempts", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("back", F.lit(False)).alias("handed_back"))


@registry.add("""
    SELECT pull, count(*) AS n, min(l_key)::BIGINT AS first, max(l_key)::BIGINT AS last FROM (
        SELECT l_orderkey * 10 + l_linenumber AS l_key, least((row_number() OVER (ORDER BY l_orderkey * 10 + l_linenumber) - 1) // ((SELECT count(*) FROM lineitem) // 3), 3) AS pull FROM lineitem)
    GROUP BY pull
""")
def pull_marks(spark, sf_dir):
    """A third of all lines a pull, until nothing is left; how far each came stands in the ledger, the target is never read."""
    scratch = Scratch(spark)
    path, book = scratch.path("target"), scratch.path("ledger")
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("l_key"))
    size, target, kind = lines.count() // 3, spec(("l_key", "UInt64"), ("pull", "UInt8")), lines.schema["l_key"].dataType
    for k in range(4):
        some = pull_increment(lines, None, "l_key", size, after=pulled_to(spark, book, "lines", kind))
        load(some.withColumn("pull", F.lit(k)), path, target, book, load_id=f"pull-{k}").close()
        note_pulled(spark, book, "lines", some, "l_key")
    rows = read_target(spark, path, target).groupBy(F.col("pull").cast("bigint").alias("pull"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min("l_key").cast("bigint").alias("first"), F.max("l_key").cast("bigint").alias("last"))


@registry.add("""
    SELECT kind, false AS visible_after_failure, count(*) AS n, sum(c_custkey)::BIGINT AS ids FROM customer, (VALUES ('moved'), ('in place')) k(kind) GROUP BY kind
""")
def export_failed(spark, sf_dir):
    """A query that fails in a late fragment leaves nothing visible, with a folder move or with a manifest; the next try does."""
    scratch, customer = Scratch(spark), table(spark, sf_dir, "customer").select("c_custkey")
    half = customer.count() // 2
    out = None
    for kind, in_place in (("moved", False), ("in place", True)):
        path = scratch.path("export")
        # the third fragment's task stops half way
        broken = customer.select(F.when(F.col("c_custkey") == half, F.raise_error(F.lit("lost"))).otherwise(F.col("c_custkey")).cast("bigint").alias("c_custkey"))
        try:
            export(broken, path, max_rows=max(1, half // 3), order_by=["c_custkey"], unique=True, in_place=in_place)
        except Exception as error:  # noqa: BLE001  the failure that is looked at
            if "lost" not in str(error):
                raise
        visible = Storage(spark).exists(path)
        export(customer, path, max_rows=max(1, half // 3), order_by=["c_custkey"], unique=True, in_place=in_place)
        rows = read_export(spark, path) if in_place else spark.read.parquet(path)
        one = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").cast("bigint").alias("ids")).select(F.lit(kind).alias("kind"), F.lit(visible).alias("visible_after_failure"), "n", "ids")
        out = one if out is None else out.unionByName(one)
    return out


@registry.add("""
    SELECT 'insert' AS statement, count(*) AS read_rows, count(*) FILTER (WHERE c_custkey % 3 = 0) AS written_rows, 0 AS result_rows, true AS bytes_known FROM customer
    UNION ALL SELECT 'select', count(*), 0, count(DISTINCT c_nationkey), true FROM customer
    UNION ALL SELECT 'join', (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation), 0, (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 0), true
""")
def statement_bytes(spark, sf_dir):
    """Rows and bytes that statements read, wrote and gave, from the figures Spark keeps of a plan it ran."""
    scratch = Scratch(spark)
    name, mark = f"bytes_{scratch.root[-32:]}", scratch.root[-32:]
    for t in ("customer", "nation"):
        table(spark, sf_dir, t).createOrReplaceTempView(f"{t}_{mark}")
    S.create_table(spark, name, [ColumnSpec("c_custkey", "Int64")], path=scratch.path("table"))
    done = {
        "insert": S.insert_select(spark, name, f"SELECT c_custkey FROM customer_{mark} WHERE c_custkey % 3 = 0"),
        "select": S.run(spark, f"SELECT c_nationkey, count(*) AS n FROM customer_{mark} GROUP BY c_nationkey"),
        "join": S.run(spark, f"SELECT c_custkey, n_name FROM customer_{mark} JOIN nation_{mark} ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 0"),
    }
    S.drop(spark, name)
    files = {t: Storage(spark).size(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation")}
    rows = []
    for statement, s in done.items():
        known = s.read_bytes == files["customer"] + (files["nation"] if statement == "join" else 0) and (s.written_bytes > 0 if statement == "insert" else s.result_bytes > 0)
        rows.append((statement, s.read_rows, s.written_rows, s.result_rows, known))
    return spark.createDataFrame(rows, "statement string, read_rows bigint, written_rows bigint, result_rows bigint, bytes_known boolean")
