"""The campaign tables of a scale directory: rows that count, NaN as null, only the columns asked for."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.residues import contact_term, residue_term
from ..operators.latest import finite, latest_rows

KEYS = {
    "molecules": ["name"], "dock6_all_poses": ["name", "pose_index"], "cross_engine_ranking": ["source_file", "name"],
    "fragment_contact_results": ["result_id"], "residue_contacts": ["contact_id"], "fragment_centroids": ["centroid_id"], "hotspots": ["hotspot_uid"],
}


#: What gives the rows of a table: (spark, directory, columns...).
Rows = Callable[..., DataFrame]


def raw(spark: SparkSession, sf: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{table}.parquet")
    return df.select(*columns) if columns else df


def latest(spark: SparkSession, sf: str, table: str, *columns: str, required: Sequence[str] | None = None) -> DataFrame:
    """The counting rows of a table, without ``loaded_at``; rows with a null in ``required`` (by default the key) are left out."""
    keys = KEYS[table]
    wanted = [*dict.fromkeys([*keys, *columns]), "loaded_at"] if columns else []
    df = raw(spark, sf, table, *wanted).dropna(subset=keys if required is None else list(required))
    near = F.floor(F.col(keys[0]) / 4096) if table == "residue_contacts" else None
    df = latest_rows(df, keys, near=near).drop("loaded_at")
    return df.withColumns({c: finite(c) for c, t in df.dtypes if t == "double"})


def poses(spark: SparkSession, sf: str) -> DataFrame:
    return latest(spark, sf, "dock6_all_poses", "grid_score", "grid_vdw_energy", "grid_es_energy").filter("grid_score is not null")


def ranking(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The counting rows of the cross-engine ranking that have a name; those whose source file is null are nobody's copies, so all count."""
    return latest(spark, sf, "cross_engine_ranking", *columns, required=["name"])


def contacts(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """(contact_id, result_id, residue, contact_type, ...) with terms instead of spellings; rows without a residue are left out."""
    df = latest(spark, sf, "residue_contacts", "result_id", "residue_id", "contact_type", *columns)
    return df.withColumns({"residue": residue_term(F.col("residue_id")), "contact_type": contact_term(F.col("contact_type"))}).drop("residue_id").filter("residue is not null")


def molecule_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """Contacts with their result's molecule, fragment and cluster."""
    results = latest(spark, sf, "fragment_contact_results", "molecule_name", "fragment_id", "fragment_label", "cluster_id").filter("molecule_name is not null")
    return contacts(spark, sf, "min_distance", "n_atom_contacts").join(results, "result_id")


def footprint(spark: SparkSession, sf: str) -> DataFrame:
    """A per-residue energy table of the shape (name, pose_id, residue_id, vdw, es, total, ref_vdw, ref_es, ref_total) from the star schema."""
    lines = raw(spark, sf, "lineitem", "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax", "l_quantity")
    parts = raw(spark, sf, "part", "p_partkey", "p_brand", "p_size")
    df = lines.join(parts, lines.l_partkey == parts.p_partkey)
    vdw, es = F.round(F.col("l_discount") * 20 - 1.5, 4) + 0.0, F.round(F.col("l_tax") * 30 - F.col("l_quantity") / 20, 4) + 0.0  # no negative zero
    return df.select(
        F.col("l_suppkey").alias("name"), (F.col("l_orderkey") % 16).cast("int").alias("pose_id"), F.col("p_brand").alias("residue_id"), vdw.alias("vdw"), es.alias("es"), (F.round(vdw + es, 4) + 0.0).alias("total"),
        (F.col("p_size") / -50.0).alias("ref_vdw"), F.lit(-0.25).alias("ref_es"),
    ).withColumn("ref_total", F.col("ref_vdw") + F.col("ref_es"))
