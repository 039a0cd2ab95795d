"""JSON message codec.

A message is a JSON array of flat objects (``[{...},{...}]``) or one object.
Decoding parses it for real (no string surgery), so text answers containing
``[``, ``]`` or ``},`` stay intact.  Every field is decoded as text and typed
afterwards: a number sent as ``5``, ``5.0`` or ``"5"`` gives 5, a missing field
gives NULL.

A message that does not parse as a whole is cut at its record boundaries and
each piece is parsed by itself, so one damaged record costs only itself.  What
still does not parse is dropped or, with ``bad='quarantine'``, returned with
its raw text.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casekit.functions.casting import conform


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


_CORRUPT = "__corrupt"
#: Between two records: a comma that follows an object or stands before one.
_BOUNDARY = r"(?<=\})\s*,\s*|\s*,\s*(?=\{)"


def _pieces(df: DataFrame, schema: T.StructType, value_col: str) -> DataFrame:
    """Add ``__recs``, the records of each message as array<struct> of text fields, and, where
    a message does not parse as a whole, ``__pieces``: array<struct<rec, raw>>, of which ``rec``
    is NULL where the raw text is no record (else ``__pieces`` is NULL)."""
    text = _as_text(schema)
    value = F.col(value_col).cast("string")
    body = F.regexp_replace(F.regexp_replace(value, r"^\s*\[\s*", ""), r"\s*\]\s*$", "")
    checked = T.StructType([*text.fields, T.StructField(_CORRUPT, T.StringType(), True)])

    def piece(p):
        return F.struct(p.alias("raw"), F.from_json(
            p, checked, {"columnNameOfCorruptRecord": _CORRUPT}).alias("rec"))

    def is_record(p):
        return (p["rec"].isNotNull() & p["rec"][_CORRUPT].isNull()
                & F.ltrim(p["raw"]).startswith("{"))

    def fields(p):
        return F.struct(*[p["rec"][f.name].alias(f.name) for f in text.fields])

    def told(p):
        good = F.coalesce(is_record(p), F.lit(False))
        return F.struct(F.when(good, fields(p)).alias("rec"), F.when(~good, p["raw"]).alias("raw"))

    whole = df.withColumn("__recs", F.from_json(value, T.ArrayType(text)))
    # a NULL element stands for something that is no object: look at the pieces then
    damaged = F.col("__recs").isNull() | F.exists("__recs", lambda r: r.isNull())
    cut = F.transform(F.filter(F.split(body, _BOUNDARY), lambda p: F.trim(p) != ""), piece)
    return whole.withColumn("__pieces", F.when(damaged & value.isNotNull(), F.transform(cut, told)))


def damaged_messages(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """The messages that do not parse as a whole."""
    text = _as_text(schema)
    recs = F.from_json(F.col(value_col).cast("string"), T.ArrayType(text))
    # one expression with one parse in it, for a filter computes a repeated one again
    none = F.array(F.lit(None).cast(text))
    return df.where(F.exists(F.coalesce(recs, none), lambda r: r.isNull()))


def decode_marked(df: DataFrame, schema: T.StructType, value_col: str = "value",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per piece of each message, each parsed once: typed records, whose ``raw`` is
    NULL, and pieces that are no records, with their raw text in ``raw``."""
    parsed, text = _pieces(df, schema, value_col), _as_text(schema)
    whole = F.transform("__recs", lambda r: F.struct(r.alias("rec"), F.lit(None).cast("string").alias("raw")))
    # the outer form: for the inner one Spark would filter on the array, and parse once more
    rows = (parsed.select(*keep, F.explode_outer(F.coalesce("__pieces", whole)).alias("__p"))
            .where("__p IS NOT NULL")
            .select(*keep, *[F.col("__p.rec")[f.name].alias(f.name) for f in text.fields],
                    F.col("__p.raw").alias("__raw")))
    return _typed(rows, df, schema, keep, ["__raw"]).withColumnRenamed("__raw", "raw")


def _typed(rows: DataFrame, df: DataFrame, schema: T.StructType, keep: tuple[str, ...],
           more: list[str]) -> DataFrame:
    return conform(rows, T.StructType([T.StructField(k, df.schema[k].dataType, True) for k in keep]
                                      + list(schema.fields) + [rows.schema[c] for c in more]))


def decode_json(df: DataFrame, schema: T.StructType, value_col: str = "value",
                bad: str = "drop", keep: tuple[str, ...] = ()) -> DataFrame | tuple[DataFrame, DataFrame]:
    """One typed record per object in each message.

    ``schema`` is the target (typed) schema; ``keep`` names input columns to
    carry along (e.g. a Kafka timestamp).  With ``bad='quarantine'`` returns
    ``(records, rejects)`` where ``rejects`` holds the raw text of every piece
    that did not parse.  Where both are needed, persist ``decode_marked`` and take
    ``split_marked`` of it: one parse.
    """
    if bad == "drop":
        parsed = _pieces(df, schema, value_col)
        recs = F.when(F.col("__pieces").isNull(), F.col("__recs")).otherwise(
            F.transform(F.filter("__pieces", lambda p: p["raw"].isNull()), lambda p: p["rec"]))
        # the choice in a step before, for beside it the explode would run without code of its own
        chosen = parsed.select(*keep, recs.alias("__chosen"))
        good = chosen.select(*keep, F.explode_outer("__chosen").alias("__r")).where("__r IS NOT NULL")
        return _typed(good.select(*keep, "__r.*"), df, schema, keep, [])
    if bad != "quarantine":
        raise ValueError("bad must be 'drop' or 'quarantine'")
    return split_marked(decode_marked(df, schema, value_col, keep), schema, keep)


def split_marked(marked: DataFrame, schema: T.StructType,
                 keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Records and rejects of ``decode_marked``."""
    return (marked.where("raw IS NULL").select(*keep, *schema.fieldNames()),
            marked.where("raw IS NOT NULL").select(*keep, "raw", F.lit("unparseable JSON").alias("reason")))


def text_fields(df: DataFrame, ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Every column as text, timestamps in ``ts_format`` (the wire format)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(f.name, ts_format).alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*cols)


#: Time stamps keep all their digits on the wire.
_TO_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row in column ``value`` (NULL fields are omitted)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), _TO_JSON).alias("value"))


def encode_arrays(df: DataFrame, max_rows: int = 20) -> DataFrame:
    """JSON-array messages of at most ``max_rows`` records each."""
    return pack_arrays(encode_rows(df), max_rows)


def pack_arrays(records: DataFrame, max_rows: int = 20) -> DataFrame:
    """Records (column ``value``, one JSON object each) as JSON arrays of at most ``max_rows``.

    Records are grouped by their position inside their own partition: a narrow map, without a
    shuffle, that holds one Arrow batch at a time.
    """
    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        rest = pa.array([], pa.string())

        def messages(recs):
            ends = np.append(np.arange(0, len(recs), max_rows), len(recs)).astype(np.int32)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), recs), ",")
            return pa.RecordBatch.from_arrays([pc.binary_join_element_wise("[", joined, "]", "")], ["value"])

        for b in batches:
            recs = pa.concat_arrays([rest, b.column(0).cast(pa.string()).drop_null()])
            full = len(recs) - len(recs) % max_rows
            rest = recs[full:]
            if full:
                yield messages(recs[:full])
        if len(rest):
            yield messages(rest)

    return records.select("value").mapInArrow(pack, "value string")
