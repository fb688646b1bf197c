"""Columns from other tables: metadata by key, nested metadata, lookups, and filters by a list of names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def named_only(df: DataFrame, names: Sequence[str] | DataFrame | None, name: str = "name") -> DataFrame:
    """Rows whose ``name`` is in a list or in the column ``name`` of a table; all rows for None or an empty list."""
    if isinstance(names, DataFrame):
        return df.join(names.select(name).filter(F.col(name).isNotNull()).distinct(), name, "left_semi")
    return df.filter(F.col(name).isin(list(names))) if names else df


def left_filled(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join, then 0 for every null of a numeric column, of both sides. Strings and other types keep their nulls."""
    out = left.join(right, list(on), "left")
    return out.fillna(0, subset=[f.name for f in out.schema.fields if isinstance(f.dataType, _NUMBERS) and f.name not in on])


def with_metadata(results: DataFrame, metadata: DataFrame, key: str = "name", metadata_key: str | None = None) -> DataFrame:
    """Results with those columns of ``metadata`` that they lack, joined by the keys as strings. Of a key that comes twice in the metadata one row counts, the least."""
    own = metadata_key or key
    new = [c for c in metadata.columns if c not in results.columns and c != own]
    one = metadata.filter(F.col(own).isNotNull()).groupBy(F.col(own).cast("string").alias("__key")).agg(F.min(F.struct(*new)).alias("__m")) if new else None
    if one is None:
        return results
    joined = results.join(one, results[key].cast("string") == one["__key"], "left")
    return joined.select(*[results[c] for c in results.columns], *[F.col("__m")[c].alias(c) for c in new])


def flattened(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as columns ``outer.inner``, at any depth."""

    def walk(kind: T.StructType, at, prefix: str):
        for f in kind.fields:
            column, name = at(f.name), f"{prefix}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, lambda x, c=column: c[x], f"{name}{separator}")
            else:
                yield column.alias(name)

    return df.select(*walk(df.schema, lambda x: F.col(f"`{x}`"), ""))


def with_nested_metadata(results: DataFrame, inputs: DataFrame, column: str = "metadata", key: str = "name") -> DataFrame:
    """Results with the flattened fields of a nested metadata column of ``inputs``."""
    flat = flattened(inputs.select(F.col(key), F.col(column)), "_")
    return with_metadata(results, flat.withColumnsRenamed({c: c.removeprefix(f"{column}_") for c in flat.columns if c != key}), key)


def with_contributions(centroids: DataFrame, contributions: DataFrame, score_keys: Sequence[str]) -> DataFrame:
    """Centroids (name, fragment_id, cluster) with ``score_contribution`` of the first of ``score_keys`` that has any; 0 where it has none.

    ``contributions``: (name, score_key, fragment_id, cluster, coefficient), as from the regression.
    """
    place = F.coalesce(*[F.when(F.col("score_key") == k, i) for i, k in enumerate(score_keys)])
    placed = contributions.withColumn("__p", place).filter("__p is not null")
    first = placed.groupBy("name").agg(F.min("__p").alias("__p"))
    own = placed.join(first, ["name", "__p"]).groupBy("name", "fragment_id", "cluster").agg(F.max("coefficient").alias("score_contribution"))
    return centroids.drop("score_contribution").join(own, ["name", "fragment_id", "cluster"], "left").fillna(0.0, ["score_contribution"])


#: Columns of protein-ligand interactions found by an external program; without it the table is empty.
INTERACTIONS = "name string, residue_id string, interaction_type string, distance double, angle double"


def with_interactions(rows: DataFrame, interactions: DataFrame, keys: Sequence[str] = ("residue_id",)) -> DataFrame:
    """Rows with ``interactions``, the sorted kinds of interaction of their residue, empty where there is none."""
    kinds = interactions.groupBy(*keys).agg(F.sort_array(F.collect_set("interaction_type")).alias("interactions"))  # bounded by the kinds there are
    return rows.join(kinds, list(keys), "left").withColumn("interactions", F.coalesce("interactions", F.array().cast("array<string>")))
