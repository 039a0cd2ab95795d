"""Small fixed tables as SQL ``VALUES`` relations.

A ``VALUES`` relation is a local relation with exact size statistics, so
Catalyst broadcasts it by itself and never shuffles a join against it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def literal_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A DataFrame holding ``rows`` with exactly ``schema`` (names and types)."""
    rows = list(rows)
    names = schema.fieldNames()
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"`{n}`" for n in names)
    casts = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                      for f in schema.fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({cols})")
