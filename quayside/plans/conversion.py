"""Registered queries: alignment and typed conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.convert import ERRORS, conform
from quayside.functions.normalize import ResultError, normalize
from quayside.operators.align import AlignmentError, align
from quayside.plans.tables import Registry, table
from quayside.types import ColumnSpec, spec

registry = Registry()


def _bad(errors: str = ERRORS):
    return F.size(F.col(errors)).alias("n_errors")


@registry.add("""
    SELECT c_custkey, c_name, c_nationkey::INT AS c_nationkey, 100.5::DOUBLE AS c_acctbal, c_mktsegment
    FROM customer
""")
def align_defaults(spark, sf_dir):
    target = [
        ColumnSpec("c_custkey", "Int64"), ColumnSpec("c_name", "String"), ColumnSpec("c_nationkey", "UInt8"),
        ColumnSpec("c_acctbal", "Float64", default="100.5"), ColumnSpec("c_mktsegment", "String"),
    ]
    records = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey", "c_name", "c_custkey")
    full = align(records, target, "customer", fill_defaults=True)
    return conform(full, target).withColumn("c_nationkey", F.col("c_nationkey").cast("int")).drop(ERRORS)


@registry.add("""
    SELECT l_orderkey, l_linenumber,
           CASE l_orderkey % 7 WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN 0 ELSE l_orderkey END AS as_int64,
           CASE WHEN l_linenumber * 50 <= 255 THEN l_linenumber * 50 END AS as_uint8,
           CASE WHEN l_quantity * 4 <= 127 AND l_orderkey % 2 = 0 THEN (l_quantity * 4)::INT END AS as_int8,
           (CASE WHEN l_orderkey % 7 IN (3, 4) THEN 1 ELSE 0 END
            + CASE WHEN l_linenumber * 50 > 255 THEN 1 ELSE 0 END
            + CASE WHEN l_quantity * 4 <= 127 AND l_orderkey % 2 = 0 THEN 0 ELSE 1 END)::INT AS n_errors
    FROM lineitem
""")
def conform_ints(spark, sf_dir):
    kind, key = F.col("l_orderkey") % 7, F.col("l_orderkey").cast("string")
    records = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(kind == 0, F.concat(key, F.lit(".0"))).when(kind == 1, F.concat(key, F.lit("0e-1")))
        .when(kind == 2, F.concat(F.lit(" "), key, F.lit("\t"))).when(kind == 3, F.concat(key, F.lit(".5")))
        .when(kind == 4, F.concat(key, F.lit("abc"))).when(kind == 5, F.lit(None)).otherwise(key).alias("as_int64"),
        (F.col("l_linenumber") * 50).alias("as_uint8"),
        F.when(F.col("l_orderkey") % 2 == 0, F.col("l_quantity") * 4).otherwise(F.col("l_quantity") + 0.5).alias("as_int8"),
    )
    target = spec(("as_int64", "Int64"), ("as_uint8", "UInt8"), ("as_int8", "Int8"))
    done = conform(records, target, keep=["l_orderkey", "l_linenumber"])
    return done.select("l_orderkey", "l_linenumber", "as_int64", F.col("as_uint8").cast("int"), F.col("as_int8").cast("int"), _bad())


@registry.add("""
    SELECT o_orderkey,
           CASE WHEN o_orderkey::HUGEINT * 2459565876494607 <= 18446744073709551615::HUGEINT
                THEN (o_orderkey::HUGEINT * 2459565876494607)::VARCHAR END AS from_text,
           CASE WHEN o_custkey - 500 >= 0 THEN (o_custkey - 500)::VARCHAR END AS from_long
    FROM orders
""")
def conform_uint64(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey").cast("decimal(20,0)") * F.lit(2459565876494607).cast("decimal(17,0)")).cast("string").alias("from_text"),
        (F.col("o_custkey") - 500).alias("from_long"),
    )
    done = conform(records, spec(("from_text", "UInt64"), ("from_long", "UInt64")), keep=["o_orderkey"])
    return done.select("o_orderkey", F.col("from_text").cast("string"), F.col("from_long").cast("string"))


@registry.add("""
    WITH digits AS (
        SELECT o_orderkey, o_orderkey % 3 = 2 AS negative,
               CASE WHEN o_orderkey = 0 THEN '0' ELSE o_orderkey::VARCHAR || repeat('0', (o_orderkey % 80)::INT) END AS d
        FROM orders)
    SELECT o_orderkey,
           CASE WHEN length(d) < 39 OR (length(d) = 39 AND d <=
                     CASE WHEN negative THEN '170141183460469231731687303715884105728' ELSE '170141183460469231731687303715884105727' END)
                THEN CASE WHEN negative AND d <> '0' THEN '-' ELSE '' END || d END AS as_int128,
           CASE WHEN (NOT negative OR d = '0') AND (length(d) < 78 OR (length(d) = 78 AND d <=
                     '115792089237316195423570985008687907853269984665640564039457584007913129639935'))
                THEN d END AS as_uint256
    FROM digits
""")
def conform_wide_int(spark, sf_dir):
    key, kind, zeros = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 3, (F.col("o_orderkey") % 80).cast("int")
    sign = F.when(kind == 2, F.lit("-")).otherwise(F.lit(""))
    spelled = F.when(kind == 1, F.concat(key, F.lit("E+"), zeros.cast("string"))).otherwise(
        F.concat(sign, F.lit("00"), key, F.repeat(F.lit("0"), zeros), F.lit(".0"))
    )
    records = table(spark, sf_dir, "orders").select("o_orderkey", spelled.alias("as_int128"), spelled.alias("as_uint256"))
    return conform(records, spec(("as_int128", "Int128"), ("as_uint256", "UInt256")), keep=["o_orderkey"]).drop(ERRORS)


@registry.add("""
    SELECT event_id,
           CASE event_id % 9 WHEN 0 THEN 'NaN' WHEN 1 THEN 'refused' WHEN 2 THEN 'Infinity' WHEN 3 THEN 'refused'
                             WHEN 4 THEN '0' ELSE 'number' END AS kind,
           CASE WHEN event_id % 9 = 4 THEN 0 WHEN event_id % 9 > 4 THEN value * 1000 END AS as_float64,
           CASE WHEN event_id % 9 = 4 THEN 0 WHEN event_id % 9 > 4 THEN (value * 1000)::FLOAT::DOUBLE END AS as_float32
    FROM events
""")
def conform_float(spark, sf_dir):
    kind = F.col("event_id") % 9
    spelled = (
        F.when(kind == 0, F.lit(" NaN")).when(kind == 1, F.lit("inf")).when(kind == 2, F.lit("+Infinity")).when(kind == 3, F.lit("1,5"))
        .when(kind == 4, F.lit(None)).otherwise((F.col("value") * 1000).cast("string"))
    )
    records = table(spark, sf_dir, "events").select("event_id", spelled.alias("d"), spelled.alias("f"))
    done = conform(records, spec(("d", "Float64"), ("f", "Float32")), keep=["event_id"])
    finite = ~F.isnan("d") & (F.abs("d") != float("inf"))
    label = (
        F.when(F.col("d").isNull(), "refused").when(F.isnan("d"), "NaN").when(F.col("d") == float("inf"), "Infinity")
        .when(F.col("event_id") % 9 == 4, F.col("d").cast("int").cast("string")).otherwise("number")
    )
    return done.select("event_id", label.alias("kind"), F.when(finite, F.col("d")).alias("as_float64"),
                       F.when(finite, F.col("f").cast("double")).alias("as_float32"))


@registry.add("""
    SELECT l_orderkey, l_linenumber,
           TRY_CAST(CASE WHEN l_orderkey % 10 = 3 THEN '9999999' ELSE '' END || l_partkey || '.' || lpad((l_suppkey * 37 % 1000)::VARCHAR, 3, '0')
                    AS DECIMAL(9, 2))::VARCHAR AS from_text,
           CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(12, 1))::VARCHAR AS from_double,
           l_partkey || '.' || lpad((l_suppkey * 37 % 1000)::VARCHAR, 3, '0') || '00' AS as_decimal76
    FROM lineitem
""")
def conform_decimal(spark, sf_dir):
    number = F.concat(F.col("l_partkey").cast("string"), F.lit("."), F.lpad((F.col("l_suppkey") * 37 % 1000).cast("string"), 3, "0"))
    records = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.when(F.col("l_orderkey") % 10 == 3, F.lit("9999999")).otherwise(F.lit("")), number).alias("from_text"),
        F.col("l_extendedprice").alias("from_double"), number.alias("as_decimal76"),
    )
    target = spec(("from_text", "Decimal(9, 2)"), ("from_double", "Decimal(12, 1)"), ("as_decimal76", "Decimal(76, 5)"))
    done = conform(records, target, keep=["l_orderkey", "l_linenumber"])
    return done.select("l_orderkey", "l_linenumber", F.col("from_text").cast("string"), F.col("from_double").cast("string"), "as_decimal76")


@registry.add("""
    SELECT event_id,
           CASE event_type WHEN 'view' THEN true WHEN 'click' THEN false WHEN 'purchase' THEN true WHEN 'signup' THEN false END AS from_text,
           user_id % 3 <> 0 AS from_number,
           CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS n_errors
    FROM events
""")
def conform_bool(spark, sf_dir):
    word = (
        F.when(F.col("event_type") == "view", "yes").when(F.col("event_type") == "click", " No ")
        .when(F.col("event_type") == "purchase", "T").when(F.col("event_type") == "signup", "").otherwise("maybe")
    )
    records = table(spark, sf_dir, "events").select("event_id", word.alias("from_text"), (F.col("user_id") % 3).alias("from_number"))
    done = conform(records, spec(("from_text", "Bool"), ("from_number", "Bool")), keep=["event_id"])
    return done.select("event_id", "from_text", "from_number", _bad())


@registry.add("""
    SELECT doc_id, md5(CASE WHEN strlen(text) <= 3000 THEN text END) AS fits_3000, md5(lang) AS lang_32,
           CASE WHEN strlen(text) > 3000 THEN 1 ELSE 0 END AS n_errors
    FROM documents
""")
def conform_fixed_string(spark, sf_dir):
    # the text without NULs at its end; fixed strings are padded with them
    records = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("fits_3000"), F.concat("lang", F.lit("\0\0")).alias("lang_32")
    )
    done = conform(records, spec(("fits_3000", "FixedString(3000)"), ("lang_32", "FixedString(32)")), keep=["doc_id"])
    return done.select("doc_id", F.md5("fits_3000").alias("fits_3000"), F.md5("lang_32").alias("lang_32"), _bad())


@registry.add("""
    WITH h AS (SELECT o_orderkey, md5(o_orderkey::VARCHAR) AS m FROM orders)
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 5 = 3 THEN NULL WHEN o_orderkey % 5 = 4 THEN '00000000-0000-0000-0000-000000000000'
                ELSE m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] END AS id
    FROM h
""")
def conform_uuid(spark, sf_dir):
    m = F.md5(F.col("o_orderkey").cast("string"))
    spelled = F.concat_ws("-", *[F.substring(m, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 1, F.upper(spelled)).when(kind == 2, F.concat(F.lit(" "), spelled, F.lit("\n")))
        .when(kind == 3, m).when(kind == 4, F.lit(None)).otherwise(spelled)
    )
    records = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("id"))
    return conform(records, spec(("id", "UUID")), keep=["o_orderkey"]).drop(ERRORS)


@registry.add("""
    SELECT o_orderkey,
           CASE o_orderkey % 6 WHEN 0 THEN o_orderdate::DATE WHEN 1 THEN o_orderdate::DATE + 1 WHEN 2 THEN NULL
                WHEN 3 THEN NULL WHEN 4 THEN DATE '1970-01-01' ELSE NULL END AS as_date,
           CASE o_orderkey % 6 WHEN 0 THEN o_orderdate::DATE WHEN 1 THEN o_orderdate::DATE + 1 WHEN 2 THEN NULL
                WHEN 3 THEN DATE '1960-01-01' WHEN 4 THEN DATE '1970-01-01' ELSE NULL END AS as_date32,
           CASE WHEN o_orderkey BETWEEN 0 AND 65535 THEN DATE '1970-01-01' + o_orderkey::INT END AS from_day_number
    FROM orders
""")
def conform_dates(spark, sf_dir):
    day, kind = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 6
    text = (
        F.when(kind == 0, day).when(kind == 1, F.concat(day, F.lit("T23:30:00-05:00"))).when(kind == 2, F.lit("2024-3-5"))
        .when(kind == 3, F.lit("1960-01-01")).when(kind == 4, F.lit(None)).otherwise(F.lit("19797"))
    )
    records = table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("as_date"), text.alias("as_date32"), F.col("o_orderkey").alias("from_day_number")
    )
    target = spec(("as_date", "Date"), ("as_date32", "Date32"), ("from_day_number", "Date"))
    return conform(records, target, keep=["o_orderkey"]).drop(ERRORS)


@registry.add("""
    SELECT event_id,
           CASE event_id % 6 WHEN 0 THEN epoch_us(ts) WHEN 1 THEN epoch_us(ts) - 10800000000
                WHEN 2 THEN epoch_us(ts) - 7200000000 WHEN 3 THEN NULL WHEN 4 THEN 0 ELSE NULL END // 1000000 AS seconds,
           CASE event_id % 6 WHEN 0 THEN epoch_us(ts) WHEN 1 THEN epoch_us(ts) - 10800000000
                WHEN 2 THEN epoch_us(ts) - 7200000000 WHEN 3 THEN NULL WHEN 4 THEN 0 ELSE NULL END // 1000 AS millis,
           epoch_us(ts) - 7200000000 AS from_local,
           event_id * 1000000 // 4 - 1000000000 AS from_seconds
    FROM events
""")
def conform_datetime(spark, sf_dir):
    iso, kind = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.col("event_id") % 6
    text = (
        F.when(kind == 0, F.concat(iso, F.lit("Z"))).when(kind == 1, F.concat(iso, F.lit("+03:00")))
        .when(kind == 2, F.translate(iso, "T", " ")).when(kind == 3, F.concat(iso, F.lit("+0300"))).when(kind == 4, F.lit(None))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    records = table(spark, sf_dir, "events").select(
        "event_id", text.alias("seconds"), text.alias("millis"), F.col("ts").alias("from_local"),
        (F.col("event_id") / 4 - 1000).alias("from_seconds"),
    )
    target = spec(("seconds", "DateTime"), ("millis", "DateTime64(3)"), ("from_local", "DateTime64(6)"), ("from_seconds", "DateTime64(6)"))
    done = conform(records, target, local_zone="Europe/Bucharest", keep=["event_id"])
    return done.select("event_id", F.unix_seconds("seconds").alias("seconds"), F.unix_millis("millis").alias("millis"),
                       F.unix_micros("from_local").alias("from_local"), F.unix_micros("from_seconds").alias("from_seconds"))


@registry.add("""
    SELECT event_id,
           CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS by_name,
           CASE user_id % 4 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'signup' END AS by_number,
           CASE user_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'high' WHEN 2 THEN NULL ELSE 'low' END AS by_digits
    FROM events
""")
def conform_enum(spark, sf_dir):
    kind = F.col("user_id") % 4
    records = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("by_name"), kind.alias("by_number"),
        F.when(kind == 0, "-5").when(kind == 1, "300").when(kind == 2, "7").otherwise(F.lit(None)).alias("by_digits"),
    )
    kinds = "Enum8('click' = 0, 'view' = 1, 'signup' = 2, 'purchase' = 9)"
    target = spec(("by_name", kinds), ("by_number", kinds), ("by_digits", "Enum16('low' = -5, 'high' = 300)"))
    return conform(records, target, keep=["event_id"]).drop(ERRORS)


@registry.add("""
    SELECT p_partkey,
           array_to_string(string_split(p_name, ' '), '|') AS words,
           CASE WHEN p_partkey <= 255 THEN p_size || ',' || p_partkey || ',0' END AS bytes,
           p_size || ',' || 'null' || ',' || p_partkey AS maybe,
           CASE WHEN p_partkey % 3 <> 0 THEN '[' || p_size || '][]' END AS nested
    FROM part
""")
def conform_array(spark, sf_dir):
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    records = table(spark, sf_dir, "part").select(
        "p_partkey", F.split("p_name", " ").alias("words"),
        F.array(size, key, F.lit(None)).alias("bytes"), F.array(size, F.lit(None), key).alias("maybe"),
        F.array(F.array(F.when(F.col("p_partkey") % 3 == 0, F.lit("x")).otherwise(size)), F.array().cast("array<string>")).alias("nested"),
    )
    target = spec(("words", "Array(LowCardinality(String))"), ("bytes", "Array(UInt8)"), ("maybe", "Array(Nullable(Int32))"),
                  ("nested", "Array(Array(Int16))"))
    done = conform(records, target, keep=["p_partkey"])
    listed = F.transform("nested", lambda a: F.concat(F.lit("["), F.concat_ws(",", a.cast("array<string>")), F.lit("]")))
    return done.select("p_partkey", F.array_join("words", "|").alias("words"), F.array_join(F.col("bytes").cast("array<string>"), ",").alias("bytes"),
                       F.array_join(F.col("maybe").cast("array<string>"), ",", "null").alias("maybe"), F.array_join(listed, "").alias("nested"))


@registry.add("""
    SELECT c_custkey,
           CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_nationkey::VARCHAR || '/' || c_custkey END AS tags,
           CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE c_custkey || ':' || c_mktsegment END AS pair,
           '10.' || (c_custkey // 65536 % 256) || '.' || (c_custkey // 256 % 256) || '.' || (c_custkey % 256) AS ip,
           (CASE WHEN c_custkey % 4 = 3 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 5 = 4 THEN 1 ELSE 0 END)::INT AS n_errors
    FROM customer
""")
def conform_nested(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    octet = lambda n: (F.floor(F.col("c_custkey") / n) % 256).cast("string")
    tags = F.concat(F.lit('{"nation": '), F.col("c_nationkey").cast("string"), F.lit(', "key": "'), key,
                    F.when(F.col("c_custkey") % 4 == 3, F.lit("x")).otherwise(F.lit("")), F.lit('"}'))
    pair = F.concat(F.lit('{"id": '), key, F.lit(', "segment": "'), F.col("c_mktsegment"),
                    F.when(F.col("c_custkey") % 5 == 4, F.lit('", "more": "1"}')).otherwise(F.lit('"}')))
    records = table(spark, sf_dir, "customer").select(
        "c_custkey", tags.alias("tags"), pair.alias("pair"),
        F.concat_ws(".", F.lit("10"), octet(65536), octet(256), octet(1)).alias("ip"),
    )
    target = spec(("tags", "Map(String, Int64)"), ("pair", "Tuple(id UInt32, segment String)"), ("ip", "IPv4"))
    done = conform(records, target, keep=["c_custkey"])
    return done.select(
        "c_custkey",
        F.concat(F.try_element_at("tags", F.lit("nation")).cast("string"), F.lit("/"), F.try_element_at("tags", F.lit("key")).cast("string")).alias("tags"),
        F.concat(F.col("pair.id").cast("string"), F.lit(":"), F.col("pair.segment")).alias("pair"), "ip", _bad(),
    )


@registry.add("""
    SELECT 'l_orderkey' AS column_name, 'UInt16' AS type_name, count(*) AS n FROM lineitem WHERE l_orderkey % 11 = 5 HAVING count(*) > 0
    UNION ALL SELECT 'l_quantity', 'Int8', count(*) FROM lineitem WHERE l_quantity * 3 > 127 HAVING count(*) > 0
    UNION ALL SELECT 'l_shipdate', 'DateTime', count(*) FROM lineitem WHERE l_linenumber = 7 HAVING count(*) > 0
""")
def reject_reasons(spark, sf_dir):
    records = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 11 == 5, F.lit("n/a")).otherwise((F.col("l_orderkey") % 60000).cast("string")).alias("l_orderkey"),
        (F.col("l_quantity") * 3).cast("string").alias("l_quantity"),
        F.when(F.col("l_linenumber") == 7, F.lit("15/03/2024 11:45:10")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("l_shipdate"),
    )
    done = conform(records, spec(("l_orderkey", "UInt16"), ("l_quantity", "Int8"), ("l_shipdate", "DateTime")))
    reason = done.select(F.explode(ERRORS).alias("reason"))
    pattern = r"^column '([^']+)' \(([^)]+)\): .+ \[value of type String\]$"
    named = reason.select(F.regexp_extract("reason", pattern, 1).alias("column_name"), F.regexp_extract("reason", pattern, 2).alias("type_name"))
    return named.groupBy("column_name", "type_name").agg(F.count(F.lit(1)).alias("n"))


@registry.add("""
    SELECT kase, true AS refused, count(*) AS n, sum(CASE WHEN kase = 'doubled name' THEN length(c_name) ELSE c_custkey END)::BIGINT AS total
    FROM customer, (VALUES ('unknown field'), ('computed column'), ('nothing matches'), ('type of the other path'), ('doubled name')) cases(kase) GROUP BY kase
""")
def refusals(spark, sf_dir):
    """Frames over the customers that are refused before any row is read, and the rows of the same frames put right."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    key, name = ColumnSpec("c_custkey", "Int64"), ColumnSpec("c_name", "String")
    mapped = customer.select("c_custkey", F.create_map(F.lit("k"), F.col("c_name")).alias("c_name"))
    cases = {
        "unknown field": (lambda df: align(df, [key]), customer, customer.drop("c_name")),
        "computed column": (lambda df: align(df, [key, ColumnSpec("c_name", "String", computed=True)]), customer, customer.drop("c_name")),
        "nothing matches": (lambda df: align(df, [key, name]), customer.select(F.col("c_name").alias("other")), customer),
        "type of the other path": (lambda df: align(df, [key, ColumnSpec("c_name", "Map(String, String)")], typed=len(df.columns) == 1 or df is not mapped), customer, mapped),
        "doubled name": (normalize, customer.select("c_custkey", F.col("c_name").alias("c_custkey")), customer.select("c_custkey", F.col("c_name").alias("name"))),
    }
    out = None
    for case, (attempt, wrong, right) in cases.items():
        try:
            attempt(wrong)
            refused = False
        except (AlignmentError, ResultError):
            refused = True
        done = attempt(right)
        counted = F.length("name") if case == "doubled name" else F.col("c_custkey")
        one = done.agg(F.count(F.lit(1)).alias("n"), F.sum(counted).cast("bigint").alias("total")).select(F.lit(case).alias("kase"), F.lit(refused).alias("refused"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


@registry.add("""
    SELECT name, true AS nullable, count(*) AS n FROM customer, (VALUES ('c_custkey'), ('c_name'), ('tags'), ('pair')) f(name) GROUP BY name
""")
def nullable_output(spark, sf_dir):
    """Every field of a result may be null, whatever the query says, and each row has them all."""
    rows = table(spark, sf_dir, "customer").select(
        F.coalesce("c_custkey", F.lit(0)).alias("c_custkey"), F.coalesce("c_name", F.lit("")).alias("c_name"),
        F.array(F.lit("a"), F.coalesce("c_name", F.lit(""))).alias("tags"), F.struct(F.lit(1).alias("x"), F.coalesce("c_custkey", F.lit(0)).alias("y")).alias("pair"),
    )
    done = normalize(rows)
    told = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.nullable).alias("nullable"), F.col(f.name).isNotNull().alias("there")) for f in done.schema])
    return done.select(F.explode(told).alias("f")).where("f.there").groupBy("f.name", "f.nullable").agg(F.count(F.lit(1)).alias("n"))
