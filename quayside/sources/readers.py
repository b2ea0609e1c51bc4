"""Records in: files of any format, strict JSON lines, incremental pulls, table columns."""

from __future__ import annotations

import csv
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.convert import ERRORS, UNREADABLE, raw_shape
from quayside.functions.jsontext import unknown_fields, unknown_in
from quayside.functions.normalize import type_text
from quayside.operators.log import Log
from quayside.plans.storage import Storage
from quayside.types import ColumnSpec

CORRUPT = "_corrupt_record"
HEADS_AT_ONCE = 16
FORMATS = ("csv", "json", "parquet", "orc", "avro", "xml")
TYPES_PROPERTY = "quayside.columns"


def raw_schema(columns: list[ColumnSpec]) -> T.StructType:
    """Text fields for the columns of a target, nested as the target is: the input side of a conversion."""
    return T.StructType([T.StructField(s.name, raw_shape(s.type)) for s in columns if not s.computed])


def _files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files under a path, as Spark would read them; no job runs."""
    return sorted(unquote(f) for f in spark.read.text(path).inputFiles())


def _by_header(spark: SparkSession, path: str | list[str], read) -> DataFrame:
    """Files read under their own header lines, columns matched by name; those a file lacks are null there.

    Only the head of each file is opened for its header, as many at a time as ``HEADS_AT_ONCE``. ``read`` gets a header line
    and the files that have it; an empty file has none and no rows.
    """
    files, store = _files(spark, path), Storage(spark)
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        heads = list(pool.map(store.first_line, files))
    groups: dict[str, list[str]] = {}
    for name, head in zip(files, heads, strict=True):
        if head:
            groups.setdefault(head.removeprefix("\ufeff"), []).append(name)
    frames = [read(head, some) for head, some in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else read("", files)


def read_units(
    spark: SparkSession, path: str | list[str], fmt: str, columns: list[ColumnSpec], by_header: bool = False, names_only: bool = False, **options
) -> DataFrame:
    """Records of CSV or JSON-lines files, each file a load of its own.

    Adds ``load_id``, the file's path (its name with ``names_only``), and ``_unreadable``, the reason why a record could not be
    parsed, null for the others. ``load`` fails the unit of such a record like that of any bad value, and hands it back whole.
    CSV files are read under the first one's header, or with ``by_header`` each under its own; a record with too few or too many
    values is unreadable. JSON fields that the columns do not have are unknown to the reader and left out.
    """
    if fmt not in ("csv", "json"):
        raise ValueError("only csv and json lines are read record by record")
    reader = spark.read.options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    corrupt = T.StructField(CORRUPT, T.StringType())

    def framed(rows: DataFrame, fields: list[str]) -> DataFrame:
        # Spark refuses to read nothing but the corrupt text, so the test looks at the fields as well
        looked_at = F.xxhash64(*[F.col(f"`{f}`") for f in fields]) >= F.lit(-(2**63))
        reason = F.concat(F.lit(f"malformed {fmt} record: "), F.substring(CORRUPT, 1, 200))
        place = F.col("_metadata.file_name") if names_only else F.col("_metadata.file_path")
        told = F.when(F.col(CORRUPT).isNotNull() & looked_at, reason)
        return rows.select(*[F.col(f"`{f}`") for f in fields], place.alias("load_id"), told.alias(UNREADABLE))

    if fmt == "json":
        schema = raw_schema(columns)
        return framed(reader.schema(T.StructType([*schema, corrupt])).json(path), schema.fieldNames())

    def headed(head: str, files: list[str]) -> DataFrame:
        fields = next(csv.reader([head], delimiter=options.get("sep", ",")), [])
        schema = T.StructType([*[T.StructField(f, T.StringType()) for f in fields], corrupt])
        return framed(reader.schema(schema).options(header=True, escape='"').csv(files), fields)

    if by_header:
        return _by_header(spark, path, headed)
    files = _files(spark, path)
    head = next((h for h in map(Storage(spark).first_line, files) if h), "")
    return headed(head, files)


def read_records(
    spark: SparkSession, path: str | list[str], fmt: str, columns: list[ColumnSpec] | None = None, by_header: bool = False, multi_line: bool = False, **options
) -> DataFrame:
    """Records of a file or folder.

    CSV takes its field names from the header and keeps every value as text; a quote inside quotes is doubled. A file
    whose header differs from the first one's is an error; with ``by_header`` each file is read under its own, for
    which the head of each is opened. ``multi_line`` allows line breaks inside quotes, which keeps a file in one task. JSON
    lines keep scalars as text too; with ``columns`` Spark needs no pass over the
    data to find the fields. Parquet, ORC and Avro bring their own types.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    reader = spark.read.options(**options)
    if fmt == "csv":
        reader = reader.options(**{"header": True, "escape": '"', "multiLine": multi_line, "enforceSchema": False} | options)
        return _by_header(spark, path, lambda _, files: reader.csv(files)) if by_header else reader.csv(path)
    if fmt == "json":
        if columns is not None:
            return reader.schema(raw_schema(columns)).json(path)
        return reader.option("primitivesAsString", True).json(path)
    return reader.format(fmt).load(path)


def read_checked(spark: SparkSession, path: str | list[str], fmt: str, schema: T.StructType, **options) -> tuple[DataFrame, DataFrame]:
    """(records, unreadable): rows the reader cannot parse come back as ``raw`` text with the reason."""
    if fmt not in ("csv", "json"):
        raise ValueError("only csv and json lines have unreadable rows")
    # Spark refuses to read nothing but the corrupt text, so the test looks at the fields as well
    looked_at = F.xxhash64(*[F.col(f"`{f.name}`") for f in schema]) >= F.lit(-(2**63))
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(schema)
    rows = reader.option("header", options.get("header", True)).csv(path) if fmt == "csv" else reader.json(path)
    bad = F.col(CORRUPT).isNotNull() & looked_at
    reason = F.lit(f"malformed {fmt} record")
    return rows.where(~bad).drop(CORRUPT), rows.where(bad).select(F.col(CORRUPT).alias("raw"), reason.alias("reason"))


def read_json_strict(df: DataFrame, column: str, columns: list[ColumnSpec], keep: list[str] | None = None) -> DataFrame:
    """Parse a column of JSON objects into text fields; an unknown field or broken text is an error, not silent loss.

    Adds ``_errors`` like a conversion does. Feed the fields to ``conform`` for their
    values; absent fields are null there and take the type's default.
    """
    text = F.col(f"`{column}`")
    schema = raw_schema(columns)
    unknown = unknown_fields(text, schema.fieldNames())
    for s in columns:  # and of the tuples below the top level
        if not s.computed:
            unknown = F.concat(unknown, unknown_in(F.get_json_object(text, f"$['{s.name}']"), s.type, s.name))
    errors = (
        F.when(unknown.isNull(), F.array(F.lit("the text is not a JSON object")))
        .when(F.size(unknown) > 0, F.transform(unknown, lambda k: F.concat(F.lit("unknown field '"), k, F.lit("'"))))
        .otherwise(F.array().cast("array<string>"))
    )
    kept = [F.col(f"`{k}`") for k in keep or []]
    staged = df.select(*kept, F.from_json(text, schema).alias("_parsed"), errors.alias(ERRORS))
    return staged.select(*kept, *[F.col(f"_parsed.`{f.name}`").alias(f.name) for f in schema], ERRORS)


def high_water_mark(target: DataFrame, key: str):
    """The largest key loaded so far, None for an empty target."""
    return target.agg(F.max(key)).first()[0]


# Keys up to this many are sorted in one task; above, ranges are counted first.
SORTED_KEYS = 100_000
_RANGES = 1000


def _kth_key(keys: DataFrame, key: str, k: int):
    """The ``k``-th smallest key (the largest if there are fewer), None without any.

    Keys that are numbers or times are counted in ``_RANGES`` ranges, the one with the k-th is counted again, and so on until
    it holds few keys or one value: each round reads one range, and no task gets more than a share of it. Other keys are
    dealt by range and counted per task, and only the task with the k-th is looked into.
    """
    kind = keys.schema[key].dataType
    c = F.col(f"`{key}`")
    if k > SORTED_KEYS and isinstance(kind, (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DoubleType, T.FloatType)):
        number = {T.DateType: F.unix_date(c), T.TimestampType: F.unix_micros(c)}.get(type(kind), F.unix_micros(c.cast("timestamp")) if isinstance(kind, T.TimestampNTZType) else c)
        exact = not isinstance(kind, (T.DoubleType, T.FloatType))
        number = number.cast("double" if not exact else kind if isinstance(kind, T.DecimalType) else "decimal(38,0)")
        while True:
            low, high, n = keys.agg(F.min(number), F.max(number), F.count(number)).first()
            if not n or low == high or n <= k or k <= SORTED_KEYS:
                break
            width = (high - low) / _RANGES
            if width == 0:
                break
            part = F.least(F.floor((number - F.lit(low)) / F.lit(width)).cast("int"), F.lit(_RANGES - 1))
            counts = sorted(keys.groupBy(part.alias("part")).count().collect())
            before = 0
            for at, size in counts:
                if before + size >= k:
                    break
                before += size
            if before == 0 and size == n:
                break
            keys, k = keys.where(part == at), k - before
    if k <= SORTED_KEYS:
        return keys.orderBy(c).limit(k).agg(F.max(c)).first()[0]
    dealt = keys.repartitionByRange(c).select(c, F.spark_partition_id().alias("_task"))
    counts = sorted(dealt.groupBy("_task").agg(F.count(F.lit(1)).alias("n"), F.max(c).alias("last")).collect())
    before = 0
    for at, size, last in counts:
        if before + size >= k:
            few = dealt.where(F.col("_task") == at)
            rank = few.groupBy(c).count().orderBy(c).toLocalIterator()
            for value, n in rank:
                before += n
                if before >= k:
                    return value
        before += size
    return counts[-1]["last"] if counts else None


def pull_increment(source: DataFrame, target: DataFrame | None, key: str, max_rows: int, after=None) -> DataFrame:
    """The next rows of ``source`` above the target's largest ``key``, about ``max_rows`` of them.

    Both bounds end up as comparisons with literals, so JDBC and Parquet sources read
    only that range, and only the keys of one pull are ever sorted. Rows that share
    the last key all come along: a key-based pull would never see the rest again. With
    a unique key this is exactly ``max_rows`` rows.
    """
    mark = after if target is None else high_water_mark(target, key)
    ahead = source if mark is None else source.where(F.col(key) > F.lit(mark))
    ahead = ahead.where(F.col(key).isNotNull())
    last = _kth_key(ahead.select(key), key, max_rows)
    return ahead.where(F.lit(False)) if last is None else ahead.where(F.col(key) <= F.lit(last))


def pulled_to(spark: SparkSession, ledger_path: str, name: str, dtype: T.DataType):
    """How far the pull ``name`` came by its ledger, as a value of its key's type; None at the start. The target is not read."""
    text = Log(spark, ledger_path).snapshot().marks.get(name)
    return None if text is None else spark.range(1).select(F.lit(text).cast(dtype)).first()[0]


def note_pulled(spark: SparkSession, ledger_path: str, name: str, pulled: DataFrame, key: str) -> None:
    """Note in the ledger's log how far a pull came, after its rows were loaded; nothing when it was empty."""
    last = pulled.agg(F.max(key).cast("string")).first()[0]
    log = Log(spark, ledger_path)
    while last is not None and not log.put({"commit": uuid.uuid4().hex, "marks": {name: last}}, log.snapshot()):
        continue


def table_spec(spark: SparkSession, table: str) -> list[ColumnSpec]:
    """The columns of a table in position order, read afresh, so an added column is seen at once.

    Types come from the description ``create_table`` left in the table, for other
    columns from Spark's types; defaults from the column metadata.
    """
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist or has no columns")
    described = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:t)", args={"t": table}).collect()}
    known = {c["name"]: c for c in json.loads(described.get(TYPES_PROPERTY, "[]"))}
    out = []
    for f in spark.table(table).schema.fields:
        default = f.metadata.get("CURRENT_DEFAULT")
        entry = known.get(f.name)
        text = entry["type"] if entry else (type_text(f.dataType) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else f"Nullable({type_text(f.dataType)})")
        out.append(ColumnSpec(f.name, text, default, bool(entry and entry.get("computed"))))
    return out
