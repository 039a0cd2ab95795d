"""Merging history with increments, and keeping the latest version per key."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casekit.functions.casting import conform, with_load_stamp

OrderSpec = Column | str | tuple[str, str]


def _order(spec: OrderSpec) -> Column:
    """``"c"``/``("c","asc")`` -> ascending NULLS LAST; ``("c","desc")`` -> descending NULLS LAST."""
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, str):
        return F.col(spec).asc_nulls_last()
    name, direction = spec
    c = F.col(name)
    return c.desc_nulls_last() if direction.lower() == "desc" else c.asc_nulls_last()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec],
                   tiebreak: Sequence[OrderSpec] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order``, then ``tiebreak``.

    The default tie-break is every other column ascending (NULLS LAST) in
    schema order, so two rows still tied are identical and the result does not
    depend on input order.  Expressed as ``row_number() = 1``, which Spark
    plans as a partial ``WindowGroupLimit`` before the shuffle: each map task
    forwards at most one row per key, so a hot key costs no more than a cold
    one after the exchange.
    """
    order_cols = [_order(o) for o in order]
    if tiebreak is None:
        used = {k for k in keys}
        for o in order:
            if isinstance(o, str):
                used.add(o)
            elif isinstance(o, tuple):
                used.add(o[0])
        tiebreak = [c for c in df.columns if c not in used]
    order_cols += [_order(o) for o in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1).drop("__rn"))


def merge_distinct(frames: Sequence[DataFrame], schema: T.StructType,
                   stamp: str | None = "row_insertion_dttm",
                   as_of: _dt.datetime | str | None = None,
                   dates: dict[str, str] | None = None) -> DataFrame:
    """UNION DISTINCT of history and increments, then a fresh load stamp.

    Each input is conformed to ``schema`` by name (answers held as text in
    history and as int in the increment both become int), so equal records
    from different sources collapse to one row.  Any load stamp on the inputs
    is left out of the comparison and replaced afterwards.  ``dates`` maps a
    partition date column to the timestamp it is derived from; by default a
    DATE column ``x_date`` comes from ``x_timestamp``.  DISTINCT is a hash
    aggregate with a map-side partial step, so heavily repeated rows are
    combined before the shuffle.
    """
    if dates is None:
        dates = {f.name: f.name[:-len("_date")] + "_timestamp" for f in schema.fields
                 if isinstance(f.dataType, T.DateType) and f.name.endswith("_date")
                 and f.name[:-len("_date")] + "_timestamp" in schema.fieldNames()}
    body = T.StructType([f for f in schema.fields if f.name != stamp and f.name not in dates])
    merged = None
    for df in frames:
        part = conform(df, body, strict=False)
        merged = part if merged is None else merged.unionByName(part)
    merged = merged.withColumns({d: F.col(ts).cast("date") for d, ts in dates.items()})
    out = merged.distinct()
    if stamp:
        out = with_load_stamp(out, as_of=as_of, name=stamp)
    return out.select(*[c.name for c in schema.fields if c.name in out.columns])
