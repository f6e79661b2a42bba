"""Tables, Parquet and CSV: the appointment table at rest and in transit.

Text sources are read by column *name*, every field as text, and typed here:
the usual timestamp spellings (``T`` or blank, with or without a fraction, ``Z``
or an offset) all parse.  A row that can't be typed is never dropped silently:
it goes to the error frame with its text and a reason, so rows in = rows out +
error rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truant.operators.clean import normalize_columns
from truant.schema import APPOINTMENT_SCHEMA, COLUMN_ALIASES, COLUMNS, KEY

# Microsecond timestamps in text files: Spark's default CSV pattern keeps
# milliseconds only, which can move a waiting-day count at a day boundary.
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
BAD_LINE = "__bad_line"


def ddl(schema=APPOINTMENT_SCHEMA) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)


def create_table(spark: SparkSession, name: str = "APPOINTMENT_DATA", database: str = "appointment_schema",
                 location: str | None = None, schema=APPOINTMENT_SCHEMA) -> str:
    """``CREATE DATABASE`` + ``CREATE TABLE ... USING parquet`` with the
    declared 14 typed columns; returns the qualified name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl(schema)}) USING parquet{loc}")
    return f"{database}.{name}"


def create_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, database: str = "appointment_schema",
                    location: str | None = None, sort_by: list[str] | None = None) -> str:
    """Write ``df`` as a table of ``buckets`` buckets by ``keys``, each sorted by
    ``sort_by`` (default: the keys); returns the qualified name.

    Tables bucketed alike are joined, and one of them is grouped or windowed by
    its keys, without an exchange (keys of type double or float are only good for
    joins: Spark normalises them before it groups).  Rows go to their buckets by one shuffle here,
    so that each bucket is one file."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    w = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*(sort_by or keys))
    (w.option("path", location) if location else w).format("parquet").saveAsTable(f"{database}.{name}")
    return f"{database}.{name}"


def scan_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Full scan of a catalog table or a Parquet path; names normalised.
    Projection and filters applied later are pushed into the scan."""
    df = spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)
    return normalize_columns(df)


def canonical(name: str) -> str:
    """The name used everywhere for a column spelled ``name`` in a source."""
    u = name.strip().upper()
    return COLUMN_ALIASES.get(u, u)


def typed(text: Column, kind: T.DataType) -> Column:
    """The value of a text field; null if it is blank or doesn't parse."""
    t = F.trim(text)
    if isinstance(kind, T.StringType):
        return F.when(t != "", text)
    if isinstance(kind, (T.IntegerType, T.LongType)):  # whole numbers may come as 62.0
        d = t.try_cast("double")
        return F.coalesce(t.try_cast(kind), F.when(d == F.floor(d), d).try_cast(kind))
    return t.try_cast(kind)


def unreadable(fields: dict[str, Column], schema=APPOINTMENT_SCHEMA, key: str = KEY) -> Column:
    """Why a row of text ``fields`` can't be typed: its first bad field, or no key; null for a good row."""
    reasons = [F.when((F.trim(fields[f.name]) != "") & typed(fields[f.name], f.dataType).isNull(),
                      F.concat(F.lit(f"{f.name} can't be read: "), fields[f.name])) for f in schema.fields if f.name in fields]
    missing = F.when(typed(fields[key], schema[key].dataType).isNull(), F.lit(f"no {key}")) if key in fields else F.lit(f"no {key}")
    return F.coalesce(*reasons, missing)


def _parse(raw: DataFrame, schema, key: str) -> DataFrame:
    """Text rows -> typed columns, ``line`` (the text) and ``error``."""
    fields = {canonical(c): F.col(f"`{c}`") for c in raw.columns if c != BAD_LINE}
    columns = [(typed(fields[f.name], f.dataType) if f.name in fields else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    line = F.coalesce(F.col(BAD_LINE), F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in raw.columns if c != BAD_LINE]))
    error = F.coalesce(F.when(F.col(BAD_LINE).isNotNull(), F.lit("not as many fields as the header")), unreadable(fields, schema, key))
    return raw.select(*columns, line.alias("line"), error.alias("error"))


def read_csv_checked(spark: SparkSession, path: str, schema=APPOINTMENT_SCHEMA, header: bool = True,
                     multi_line: bool = False, key: str = KEY) -> DataFrame:
    """All lines of CSV files: typed columns, and ``line`` and ``error`` of those that can't be read.

    Columns are found by the header's names in any order (``header=False``: the
    schema's order); absent ones are null, others ignored.  Files must agree in
    their header, which Spark checks.  ``multi_line`` allows quoted line breaks
    inside fields, and then a file is read by one task.
    """
    options = {"header": header, "quote": '"', "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns if header else [f.name for f in schema.fields]
    text = T.StructType([*[T.StructField(c, T.StringType()) for c in names], T.StructField(BAD_LINE, T.StringType())])
    raw = spark.read.schema(text).options(enforceSchema=not header, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE, **options).csv(path)
    return _parse(raw, schema, key)


def scan_csv(spark: SparkSession, path: str, schema=APPOINTMENT_SCHEMA, header: bool = True, multi_line: bool = False) -> DataFrame:
    """The readable rows of CSV files; the others are in :func:`csv_errors`."""
    return read_csv_checked(spark, path, schema, header, multi_line).where("error is null").drop("line", "error")


def csv_errors(spark: SparkSession, path: str, schema=APPOINTMENT_SCHEMA, header: bool = True, multi_line: bool = False) -> DataFrame:
    """(line, error) of the rows that can't be read."""
    return read_csv_checked(spark, path, schema, header, multi_line).where("error is not null").select("line", "error")


def read_csv_stream(spark: SparkSession, input_dir: str, schema=APPOINTMENT_SCHEMA, columns: list[str] | None = None,
                    max_files_per_trigger: int | None = None, key: str = KEY) -> DataFrame:
    """Arriving CSV files as in :func:`read_csv_checked`.

    ``columns`` are the files' header names in their order (default: the
    declared ones); Spark compares them with each file's header.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*(columns or COLUMNS), BAD_LINE]])
    r = spark.readStream.schema(text).options(header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE,
                                              quote='"', escape='"')
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _parse(r.csv(input_dir), schema, key)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(header=True, quote='"', escape='"', timestampFormat=CSV_TIMESTAMP_FORMAT).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def cache_full(df: DataFrame, path: str) -> DataFrame:
    """Materialise a frame as Parquet in shared storage and continue from it
    (the durable local copy of the original; survives executor loss)."""
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)

