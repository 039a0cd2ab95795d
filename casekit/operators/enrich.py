"""Guarded dimension lookups.

``enrich`` left-joins a fact to any number of dimensions.  Each dimension is
guarded: its key must be unique, since a repeated key would multiply fact rows
and inflate every KPI.  The guard is part of the query plan (the dimension is
aggregated by key and a repeated key raises an error), so it costs no extra
job.  Broadcast is decided per dimension:

* ``broadcast="probe"`` (default) measures the columns to be brought: the bytes of
  their values, summed by every scan task for itself (one row a task is
  exchanged).  Up to ``max_broadcast_bytes`` the dimension is broadcast, beyond it
  the join is a shuffle (sort-merge) join, where AQE splits hot fact keys.  The
  probes of all dimensions of one call run together as a single job;
* ``broadcast=None`` leaves it to Catalyst's size estimate
  (``spark.sql.autoBroadcastJoinThreshold``; estimates of joined dimensions
  can be far off, hence not the default);
* ``broadcast=True`` forces it, for tables whose size the caller guarantees.

``prepare`` does all of this once and returns a function of the fact, so a
stream probes its dimensions when it starts and not in every batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casekit.operators.merge import latest_per_key

DEFAULT_BROADCAST_BYTES = 64 << 20


@dataclass
class DimSpec:
    """One dimension lookup.

    ``left``   fact-side keys: column names or expressions (e.g. a date cast)
    ``right``  dimension key columns, same length
    ``columns`` dimension columns to bring (default: all but the keys)
    ``rename`` new names for brought columns; ``prefix`` is applied after it
    ``how``    ``left`` keeps every fact row; ``inner`` drops unmatched ones
    ``on_duplicate`` ``error`` | ``first`` (keep the smallest row) | ``ignore``
    ``broadcast`` ``"probe"`` (measured first), ``None`` (Catalyst decides by
    estimated size), ``True`` (forced) or ``False`` (never)
    """
    df: DataFrame
    left: Sequence[str | Column]
    right: Sequence[str]
    columns: Sequence[str] | None = None
    rename: dict = field(default_factory=dict)
    prefix: str = ""
    how: str = "left"
    on_duplicate: str = "error"
    broadcast: bool | str | None = "probe"
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
    name: str = "dimension"


def guard_unique(dim: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 name: str = "dimension") -> DataFrame:
    """``dim`` reduced to one row per key, failing the query on a repeated key.

    Rows with a NULL key never match a join and are dropped.  The check runs
    inside the query that uses the dimension: no separate job.
    """
    nonnull = dim.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    per_key = nonnull.groupBy(*keys).agg(F.expr("count(1) AS __n"),
                                         *[F.expr(f"first(`{c}`) AS `{c}`") for c in cols])
    key_json = "to_json(named_struct(" + ", ".join(f"'{k}', `{k}`" for k in keys) + "))"
    ok = (f"CASE WHEN __n > 1 THEN raise_error(concat('{name}: key ', {key_json}, "
          f"' occurs more than once')) ELSE true END")
    return per_key.where(ok).drop("__n")


def _brought(spec: DimSpec) -> list[str]:
    """Key columns, then the columns that the dimension brings."""
    keys = list(spec.right)
    return keys + (list(spec.columns) if spec.columns is not None else [
        c for c in spec.df.columns if c not in keys])


def prepare_dim(spec: DimSpec, position: int = 0) -> tuple[DataFrame, list[str]]:
    """Select, rename and guard one dimension; its keys get names unique to
    ``position`` (the spec's place in one ``enrich`` call)."""
    if spec.on_duplicate not in ("error", "first", "ignore"):
        raise ValueError(f"on_duplicate must be error|first|ignore, not {spec.on_duplicate!r}")
    dim, keys = spec.df, list(spec.right)
    cols = _brought(spec)[len(keys):]
    if spec.on_duplicate == "error":
        dim = guard_unique(dim.select(*keys, *cols), keys, cols, spec.name)
    elif spec.on_duplicate == "first":
        dim = latest_per_key(dim.select(*keys, *cols), keys, order=[])
    tmp_keys = [f"__dk{position}_{j}" for j in range(len(keys))]
    out_names = [spec.prefix + spec.rename.get(c, c) for c in cols]
    dim = dim.selectExpr(*[f"`{k}` AS `{t}`" for k, t in zip(keys, tmp_keys)],
                         *[f"`{c}` AS `{n}`" for c, n in zip(cols, out_names)])
    return dim, tmp_keys


_ROW_BYTES = 16


def _value_bytes(f: T.StructField) -> str:
    """Bytes of one value as SQL: 8, and the length of text or binary."""
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return f"8 + coalesce(octet_length(`{f.name}`), 0)"
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return f"8 + coalesce(octet_length(to_json(named_struct('v', `{f.name}`))), 0)"
    return "8"


def probe_bytes(items: Sequence[tuple[DataFrame, int]]) -> list[bool]:
    """For each ``(df, max_bytes)``: does ``df`` hold at most ``max_bytes`` bytes?

    A probe is a sum with a map-side partial step: each task sends one row, however
    large the table is, and nothing is gathered before it.  All probes are unioned
    into one job so their stages run side by side.
    """
    if not items:
        return []
    parts = []
    for i, (df, _) in enumerate(items):
        row = " + ".join([str(_ROW_BYTES), *map(_value_bytes, df.schema.fields)])
        parts.append(df.selectExpr(f"{row} AS n").groupBy().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
                     .select(F.lit(i).alias("tag"), "n"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    got = {r["tag"]: r["n"] for r in u.collect()}
    return [got[i] <= limit for i, (_, limit) in enumerate(items)]


def prepare(dims: Sequence[DimSpec]) -> Callable[[DataFrame], DataFrame]:
    """Guard and measure the dimensions once; the result joins any fact to them.

    Fact-side keys are converted to the dimension key type with ``try_cast``,
    so a text key that is not a number (``"x"`` against an int key) simply
    matches nothing instead of failing the query.  Broadcast dimensions are
    all joined inside one stage: the fact is not shuffled at all.
    """
    for spec in dims:
        if len(spec.left) != len(spec.right):
            raise ValueError(f"{spec.name}: left and right keys differ in length")
    prepared = [prepare_dim(spec, i) for i, spec in enumerate(dims)]
    probed = [i for i, spec in enumerate(dims) if spec.broadcast == "probe"]
    # Measure the unguarded columns: the guarded dimension has at most as many rows.
    fits = dict(zip(probed, probe_bytes([(dims[i].df.select(*_brought(dims[i])),
                                          dims[i].max_broadcast_bytes) for i in probed])))
    small = [spec.broadcast is True or fits.get(i, False) for i, spec in enumerate(dims)]

    def join(fact: DataFrame) -> DataFrame:
        # All fact-side keys in one projection, then the joins, then the columns in their order.
        key_cols, all_tmp = [], []
        for spec, (dim, tmp_keys) in zip(dims, prepared):
            types = {f.name: f.dataType for f in dim.schema.fields}
            for expr, t in zip(spec.left, tmp_keys):
                if isinstance(expr, str):
                    key_cols.append(F.expr(
                        f"try_cast(`{expr}` AS {types[t].simpleString()}) AS `{t}`"))
                else:
                    key_cols.append(expr.try_cast(types[t]).alias(t))
                all_tmp.append(t)
        out = fact.select("*", *key_cols)
        names = [*fact.columns, *[c for dim, tmp_keys in prepared for c in dim.columns if c not in tmp_keys]]
        order = range(len(dims))
        if len({n.lower() for n in names}) == len(names):
            # shuffle joins come first: the fact moves without the columns of the other dimensions
            order = sorted(order, key=lambda i: small[i])
        for i in order:
            dim, tmp_keys = prepared[i]
            out = out.join(F.broadcast(dim) if small[i] else dim, on=tmp_keys, how=dims[i].how)
        if list(order) == list(range(len(dims))):
            return out.drop(*all_tmp)
        return out.select(*[F.col(f"`{n}`") for n in names])
    return join


def enrich(fact: DataFrame, dims: Sequence[DimSpec]) -> DataFrame:
    """Left-join (or inner-join) ``fact`` to each dimension in turn."""
    return prepare(dims)(fact)


def regional_lookup(fact: DataFrame, dim: DataFrame, date: str | Column, region: str | Column,
                    dim_date: str, dim_region: str, columns: Sequence[str], default_region: str,
                    prefix: str = "", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                    name: str = "calendar") -> DataFrame:
    """A dimension keyed by date *and* region, with a row of ``default_region`` to fall back on.

    A fact row gets the row of its date and region; where there is none (or its region is
    NULL) that of its date and the default region; where there is none either, NULLs.  A
    column that is NULL in the region's own row stays NULL.  Each (date, region) may occur
    once; every fact row comes out once.
    """
    keys = [dim_date, dim_region]
    marked = dim.select(*keys, *columns, F.lit(True).alias("__found"))
    own = DimSpec(marked, left=[date, region], right=keys, columns=["__found", *columns],
                  prefix="__own_", name=name, max_broadcast_bytes=max_broadcast_bytes)
    fallback = DimSpec(marked.where(F.col(dim_region) == default_region), left=[date],
                       right=[dim_date], columns=columns, prefix="__any_", name=name,
                       max_broadcast_bytes=max_broadcast_bytes)
    both = enrich(fact, [own, fallback])
    return both.select(*fact.columns, *[
        F.when(F.col("__own___found"), F.col(f"__own_{c}")).otherwise(F.col(f"__any_{c}"))
        .alias(prefix + c) for c in columns])


def priority_lookup(category: DataFrame, priority: DataFrame, how: str = "left") -> DataFrame:
    """Category joined to its priority.

    ``how='left'`` (batch wide table) keeps categories whose priority is
    unknown, with NULL priority columns; ``how='inner'`` (the live stream)
    drops them.  ``Priority_key`` always comes from the priority table.
    """
    cat = category.select("category_key", "sub_category_key", "category_description",
                          "sub_category_description", F.col("priority").alias("__cat_pri"))
    pri = priority.select("Priority_key", "priority", "severity", "SLA")
    return (cat.join(pri, cat["__cat_pri"] == pri["Priority_key"], how)
               .select("category_key", "sub_category_key", "category_description",
                       "sub_category_description", "Priority_key", "priority", "severity",
                       "SLA"))
