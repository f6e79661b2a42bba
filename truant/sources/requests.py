"""Request envelopes ``{"data": "<csv text with header>"}`` as a table.

The original decodes one HTTP body at a time; here a table (or stream) of
request bodies is decoded in bulk with JSON and CSV column functions, so the
same code serves a backlog of requests or a live stream of them.

A body's own header says where its columns are.  Line breaks inside quotes
belong to the field.  Whatever can't be used (a body without data, a header
without the key, a line or a value that doesn't parse) becomes an error row of
its request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truant.schema import APPOINTMENT_SCHEMA, COLUMN_ALIASES, KEY
from truant.sources.tables import CSV_TIMESTAMP_FORMAT, typed, unreadable

CSV_OPTIONS = {"timestampFormat": CSV_TIMESTAMP_FORMAT, "quote": '"', "escape": '"'}
_BREAK = "\u001e\u001f"


def csv_line(cols: list[str]) -> Column:
    return F.to_csv(F.struct(*[F.col(c) for c in cols]), CSV_OPTIONS)


def encode_requests(df: DataFrame, batch: Column, cols: list[str] | None = None,
                    id_col: str = "request_id") -> DataFrame:
    """Rows -> one request per ``batch`` value: header line + CSV lines
    (sorted for determinism), wrapped as ``{"data": ...}``.  ``batch`` must
    bound the rows per request (e.g. key div 100): each body is one group."""
    cols = cols or df.columns
    header = ",".join(cols)
    lines = df.select(batch.alias(id_col), csv_line(cols).alias("__line"))
    grouped = lines.groupBy(id_col).agg(F.array_sort(F.collect_list("__line")).alias("__lines"))
    text = F.concat(F.lit(header + "\n"), F.array_join("__lines", "\n"))
    return grouped.select(id_col, F.to_json(F.struct(text.alias("data"))).alias("body"))


def _outside_quotes(text: Column, change) -> Column:
    """``text`` with ``change`` applied to its parts outside double quotes."""
    parts = F.transform(F.split(text, '"', -1), lambda x, i: F.when(i % 2 == 0, change(x)).otherwise(x))
    return F.array_join(parts, '"')


def _records(data: Column) -> Column:
    """The records of a CSV text, at the line breaks outside quotes."""
    return F.split(_outside_quotes(data, lambda x: F.replace(F.replace(x, F.lit("\r\n"), F.lit("\n")), F.lit("\n"), F.lit(_BREAK))), _BREAK, -1)


def _once(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with columns that are computed once: a generator keeps the
    optimizer from copying their expressions into every use."""
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))))


def _fields(record: Column) -> Column:
    """The fields of a CSV record, any number of them: cut at the commas outside
    quotes; of a quoted field the quotes go, and double ones in it become single."""
    cut = F.split(_outside_quotes(F.coalesce(record, F.lit("")), lambda x: F.replace(x, F.lit(","), F.lit(_BREAK))), _BREAK, -1)
    return F.transform(cut, _unquoted)


def _unquoted(field: Column) -> Column:
    quoted = F.startswith(field, F.lit('"')) & F.endswith(field, F.lit('"')) & (F.length(field) >= 2)
    inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
    return F.when(quoted, inner).otherwise(field)


def _canonical(c: Column) -> Column:
    """A column's name, spelled as everywhere."""
    u = F.upper(F.trim(c))
    out = u
    for spelled, name in COLUMN_ALIASES.items():
        out = F.when(u == spelled, F.lit(name)).otherwise(out)
    return out


def request_lines(requests: DataFrame, id_col: str = "request_id") -> DataFrame:
    """(request id, names, width, line number, line) for every data line; a
    body without usable data, or with a header only, gives one row without a line."""
    rows = _once(requests.select(id_col, "body"), __records=_records(F.get_json_object("body", "$.data")))
    rows = _once(rows, __header=F.get("__records", F.lit(0)))
    rows = _once(rows, __f=_fields(F.col("__header")))
    rows = _once(rows, names=F.when(F.col("__header").isNotNull(), F.transform("__f", _canonical)), width=F.size("__f"))
    numbered = F.transform("__records", lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))
    lines = F.filter(numbered, lambda x: (x.line_no > 0) & (F.length(F.trim(x.line)) > 0))
    return rows.select(id_col, "names", "width", F.explode_outer(lines).alias("__l")).select(
        id_col, "names", "width", F.col("__l.line_no").alias("line_no"), F.col("__l.line").alias("line"))


def parse_requests(requests: DataFrame, schema=APPOINTMENT_SCHEMA, id_col: str = "request_id", key: str = KEY) -> DataFrame:
    """Every line of every body: request id, line number, line, error, typed columns.

    ``error`` is null for a good row; a request that gives no line at all has
    one row with its reason.
    """
    lines = _once(request_lines(requests, id_col), __f=_fields(F.col("line")))
    text = {f"__t{i}": F.when(F.array_contains("names", f.name), F.get("__f", F.array_position("names", f.name).cast("int") - 1))
            for i, f in enumerate(schema.fields)}
    lines = _once(lines, **text)
    fields = {f.name: F.col(f"__t{i}") for i, f in enumerate(schema.fields)}
    error = F.coalesce(
        F.when(F.col("names").isNull(), F.lit("the body has no text under data")),
        F.when(~F.coalesce(F.array_contains("names", key), F.lit(False)), F.lit(f"the header has no {key}")),
        F.when(F.col("line").isNull(), F.lit("no lines")),
        F.when(F.size("__f") != F.col("width"), F.lit("not as many fields as the header")),
        unreadable(fields, schema, key))
    return lines.select(id_col, "line_no", "line", error.alias("error"), *[typed(fields[f.name], f.dataType).alias(f.name) for f in schema.fields])


def decode_requests(requests: DataFrame, schema=APPOINTMENT_SCHEMA, id_col: str = "request_id",
                    keep_id: bool = False) -> DataFrame:
    """The good rows of request bodies, typed; the others are in :func:`decode_errors`."""
    out = parse_requests(requests, schema, id_col).where("error is null").drop("line", "error")
    return out if keep_id else out.drop(id_col, "line_no")


def decode_errors(requests: DataFrame, schema=APPOINTMENT_SCHEMA, id_col: str = "request_id") -> DataFrame:
    """(request id, line number, line, error): lines and whole bodies that can't be used."""
    return parse_requests(requests, schema, id_col).where("error is not null").select(id_col, "line_no", "line", "error")


def encode_responses(pred: DataFrame, id_col: str | None = None,
                     cols: tuple[str, ...] = (KEY, "PREDICTED_NO_SHOW")) -> DataFrame:
    """Predictions as JSON text: one document per row, or per request
    (sorted by key) when ``id_col`` is given; a request is one group, so its
    sender must bound its rows."""
    doc = F.struct(*[F.col(c) for c in cols])
    if id_col is None:
        return pred.select(F.col(cols[0]), F.to_json(doc).alias("response"))
    g = pred.groupBy(id_col).agg(F.array_sort(F.collect_list(doc)).alias("predictions"))
    return g.select(id_col, F.to_json(F.struct("predictions")).alias("response"))


def json_get(col: str, path: str) -> Column:
    return F.get_json_object(F.col(col), path)
