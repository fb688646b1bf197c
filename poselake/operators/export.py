"""Selected hits against the original structures, and files against names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hit_export(selection: DataFrame, originals: DataFrame, duplicates: DataFrame, name: str = "name", exclude: str | None = None) -> DataFrame:
    """Selected names with their original row, directly or through the molecule they duplicate.

    ``originals``: (name, ...) one row per name; ``duplicates``: (name, duplicate_of). ``found_as`` is the
    name used, ``exported`` whether there is one. Names that start with ``exclude`` (controls) are left out.
    """
    chosen = selection.select(name).filter(F.col(name).isNotNull()).distinct()
    if exclude:
        chosen = chosen.filter(~F.col(name).startswith(exclude))
    known = originals.select(F.col(name).alias("__k"), F.lit(True).alias("__has"))
    through = duplicates.filter("duplicate_of is not null").groupBy(name).agg(F.min("duplicate_of").alias("__dup"))
    out = chosen.join(known, chosen[name] == F.col("__k"), "left").drop("__k").join(through, name, "left")
    out = out.withColumn("found_as", F.when(F.col("__has"), F.col(name)).otherwise(F.col("__dup"))).drop("__has", "__dup")
    rows = originals.withColumnRenamed(name, "__k")
    out = out.join(rows, out.found_as == F.col("__k"), "left")
    return out.withColumn("exported", F.col("__k").isNotNull()).drop("__k")


def unresolved(selection: DataFrame, originals: DataFrame, name: str = "name") -> DataFrame:
    """Selected names without an original of their own."""
    return selection.select(name).distinct().join(originals.select(name), name, "left_anti")


def with_files(names: DataFrame, files: DataFrame, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """(names with a file, names without): the listing has the columns (name, path)."""
    return names.join(files, name, "left_semi"), names.join(files, name, "left_anti")


def resolve_sources(*sources: DataFrame, name: str = "name", path: str = "path") -> DataFrame:
    """(name, path) by precedence: the first source that has the name, except that the last one always wins if it has it."""
    if not sources:
        raise ValueError("no sources")
    ranked = [s.select(name, path, F.lit(-1 if i == len(sources) - 1 else i).alias("__p")) for i, s in enumerate(sources)]
    out = ranked[0]
    for s in ranked[1:]:
        out = out.unionByName(s)
    return out.groupBy(name).agg(F.min_by(path, F.struct("__p", path)).alias(path))
