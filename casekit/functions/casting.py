"""Casting and stamping (conform to a declared schema, event dates, load stamps).

Spark 4 runs with ANSI semantics, where a bad cast raises.  Ingest must turn a
bad value into NULL instead, so every conversion here is a ``try_cast``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trunc_seconds(c: Column | str) -> Column:
    """Cut sub-seconds, keeping the wall-clock type TIMESTAMP_NTZ.

    Rebuilt from its own fields, so no session time zone is involved (a
    round trip through TIMESTAMP could move wall times inside a DST gap).
    """
    if isinstance(c, str):
        n = f"`{c}`"
        return F.expr(f"make_timestamp_ntz(year({n}), month({n}), day({n}), hour({n}), "
                      f"minute({n}), second({n}))")
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.minute(c), F.second(c))


def now_seconds() -> Column:
    """The current wall-clock time in whole seconds (TIMESTAMP_NTZ)."""
    return F.date_trunc("second", F.localtimestamp()).cast("timestamp_ntz")


#: A whole number as text: 5, -5, +5, 5.0 or 5.; spaces around it are allowed.
_WHOLE = r"^\\s*([+-]?[0-9]+)(?:\\.0*)?\\s*$"


def _whole_sql(c: str, target: str) -> str:
    """Text that is a whole number, as the target type; anything else NULL.  It
    never passes through a double, so large numbers keep all digits."""
    return f"try_cast(nullif(regexp_extract({c}, '{_WHOLE}', 1), '') AS {target})"


def answer_to_int(c: str) -> Column:
    """A survey answer column given as 5, 5.0 or "5" becomes 5; anything else NULL."""
    return F.expr(_whole_sql(f"CAST(`{c}` AS STRING)", "int"))


def _conform_sql(src: T.StructField | None, f: T.StructField) -> str:
    name = f"`{f.name}`"
    target = f.dataType.simpleString()
    if src is None:
        return f"CAST(NULL AS {target}) AS {name}"
    c = f"`{src.name}`"
    if src.dataType == f.dataType:
        return f"{c} AS {name}"
    if isinstance(f.dataType, T.TimestampNTZType) and isinstance(src.dataType, T.TimestampType):
        return f"CAST({c} AS timestamp_ntz) AS {name}"
    if isinstance(f.dataType, T.IntegralType) and isinstance(src.dataType, T.StringType):
        return f"{_whole_sql(c, target)} AS {name}"
    return f"try_cast({c} AS {target}) AS {name}"


def conform(df: DataFrame, schema: T.StructType, *, strict: bool = True) -> DataFrame:
    """Pick, order and cast columns to ``schema``.

    Columns are matched by name (case-insensitively, as Spark resolves them),
    so a differently ordered input cannot swap values.  Values that do not
    convert become NULL.  With ``strict=False`` a missing column becomes NULL.
    """
    present = {f.name.lower(): f for f in df.schema.fields}
    exprs = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None and strict:
            raise ValueError(f"conform: input has no column {f.name!r}")
        exprs.append(_conform_sql(src, f))
    return df.selectExpr(*exprs)


def conform_checked(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """``conform`` in the same pass as a list of what did not convert.

    Adds ``rejected``: an array of ``(column, raw)``, one entry for every value that is there
    but did not convert, in schema order (empty if all did).  ``keep`` carries input columns
    along as they are, to tell where a row came from.
    """
    present = {f.name.lower(): f for f in df.schema.fields}
    typed, checks = [], []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            raise ValueError(f"conform: input has no column {f.name!r}")
        expr = _conform_sql(src, f)
        typed.append(expr)
        if src.dataType != f.dataType:
            value = expr[:expr.rindex(" AS ")]
            checks.append(f"CASE WHEN `{src.name}` IS NOT NULL AND ({value}) IS NULL THEN "
                          f"named_struct('column', '{f.name}', 'raw', CAST(`{src.name}` AS STRING)) END")
    listed = (f"filter(array({', '.join(checks)}), x -> x IS NOT NULL)" if checks else
              "CAST(array() AS array<struct<column: string, raw: string>>)")
    return df.selectExpr(*typed, *[f"`{k}`" for k in keep], f"{listed} AS rejected")


def split_rejects(checked: DataFrame, key: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that converted in full, and one row ``(key..., column, raw)`` for every value that
    did not.  Where both are needed, persist or write ``checked`` once: one conversion."""
    keys = [key] if isinstance(key, str) else list(key)
    good = checked.where(F.size("rejected") == 0).drop("rejected")
    bad = checked.select(*keys, F.explode("rejected").alias("r")).select(*keys, "r.column", "r.raw")
    return good, bad


def with_event_date(df: DataFrame, ts: str, name: str) -> DataFrame:
    """Add a DATE column derived from a timestamp (text or typed)."""
    dtype = df.schema[ts].dataType
    c = F.col(ts)
    d = c.cast("date") if isinstance(dtype, (T.TimestampType, T.TimestampNTZType,
                                             T.DateType)) else c.try_cast("date")
    return df.withColumn(name, d)


def with_load_stamp(df: DataFrame, as_of: _dt.datetime | str | None = None,
                    name: str = "row_insertion_dttm",
                    date_col: str | None = None) -> DataFrame:
    """Append the load time (whole seconds) and optionally the load date.

    ``as_of`` fixes the stamp (tests, reruns that must be reproducible);
    otherwise it is the query's current time, evaluated once per query.
    """
    stamp = now_seconds() if as_of is None else F.lit(str(as_of)).cast("timestamp_ntz")
    out = df.withColumn(name, stamp)
    if date_col:
        out = out.withColumn(date_col, F.col(name).cast("date"))
    return out
