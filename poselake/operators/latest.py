"""Rows that count: of several rows with one key, the latest one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def latest_rows(df: DataFrame, keys: Sequence[str], order: str = "loaded_at", near: Column | None = None, keep_near: bool = False) -> DataFrame:
    """Keep, for every key, the row with the greatest ``order``; input columns only.

    * equal ``order``: the row that sorts last by its remaining columns, so the choice never depends on
      partitioning; exact copies give one row;
    * null ``order`` sorts before every value;
    * a key with a null part can't be sent again, so such rows all stay. They are spread by a hash of
      their columns instead of meeting in one task.

    ``near`` is an optional expression of the key (such as ``key div 4096``). Rows are then exchanged by
    it alone, so rows with neighbouring keys stay together and a later step can reduce them before its
    own exchange: with ``keep_near`` it comes out as ``__near``, and grouping by it needs no exchange. One
    exchange and one sort; no self-join.
    """
    names = list(df.columns)
    if order not in names:
        raise ValueError(f"no column {order!r} to order by")
    rest = [f.name for f in df.schema.fields if f.name not in {*keys, order} and _orderable(f.dataType)]
    any_null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    spread = F.when(any_null, F.xxhash64(*[F.col(f"`{c}`") for c in names if _orderable(df.schema[c].dataType)]))
    by = [F.col(f"`{k}`") for k in keys]
    if near is not None:
        df = df.withColumn("__near", F.coalesce(near.cast("long"), spread))
        df = df.repartition("__near")
        by = [F.col("__near"), *by]
    else:
        df = df.withColumn("__near", spread)
        by = [*by, F.col("__near")]
    w = Window.partitionBy(*by).orderBy(F.col(f"`{order}`").asc_nulls_first(), *[F.col(f"`{c}`").asc_nulls_first() for c in rest])
    flagged = df.withColumn("__last", F.lead(F.lit(1)).over(w).isNull())
    return flagged.filter(F.col("__last") | any_null).select(*[F.col(f"`{c}`") for c in names], *["__near"] * keep_near)


def finite(column: Column | str) -> Column:
    """The value as a double, null where it isn't a finite number."""
    c = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """All floating columns with NaN turned into null (infinities stay)."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])


def first_present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first of ``candidates`` that is a column of ``df``, compared as written."""
    have = set(df.columns)
    return next((c for c in candidates if c in have), None)
