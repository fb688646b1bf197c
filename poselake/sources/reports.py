"""Text output of engines: score tables on stdout, and per-residue footprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import number, stem, tokens, whole_files


def stdout_modes(text: Column) -> Column:
    """array<struct<mode, vina_affinity, cnn_score, cnn_affinity>> of a docking engine's table.

    Blank lines, comments, the heading and the rule are skipped; a row has four words at least and a number
    first; with five and more the last two are the CNN's.
    """
    rows = F.transform(F.filter(F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n"), lambda s: ~s.rlike(r"^\s*(#|mode|-*\+?-{3}|$)")), tokens)
    good = F.filter(rows, lambda t: (F.size(t) >= 4) & F.get(t, 0).try_cast("int").isNotNull())
    last = lambda t, k: number(F.when(F.size(t) >= 5, F.get(t, F.size(t) - k)).otherwise(F.get(t, 4 - k)))
    out = F.transform(good, lambda t: F.struct(F.get(t, 0).try_cast("int").alias("mode"), number(F.get(t, 1)).alias("vina_affinity"), last(t, 2).alias("cnn_score"), last(t, 1).alias("cnn_affinity")))
    return F.filter(out, lambda m: m["vina_affinity"].isNotNull())


def stdout_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, mode, vina_affinity, cnn_score, cnn_affinity) of stdout files."""
    return whole_files(spark, path).select("path", F.inline(stdout_modes(F.col("value"))))


def footprints(spark: SparkSession, path: str | list[str], mapping: DataFrame | None = None) -> DataFrame:
    """One row per residue and pose of footprint files: name, pose_id (0-based), fps_score, residue and energies.

    Rows have eight words at least: resname resid vdw_ref es_ref hb_ref vdw es hb. ``mapping`` (seq_id,
    residue_id) renames residues; else, and where it lacks one, ``RESn.A``. Totals and differences to the
    reference are rounded to six digits. Text before the first molecule is no pose.
    """
    df = whole_files(spark, path)
    blocks = F.filter(F.split("value", r"#{20,}\n(?=### Molecule:)"), lambda s: s.startswith("### Molecule:"))
    poses = df.select("path", F.posexplode(blocks).alias("pose_id", "block"))
    name = F.trim(F.regexp_extract("block", r"^### Molecule:[ \t]*([^\n]*)", 1))
    fps = F.regexp_extract("block", r"(?m)^##\s*Footprint_Similarity_Score:\s*(\S+)", 1).try_cast("double")
    rows = F.filter(F.transform(F.split("block", "\n"), tokens), lambda t: (F.size(t) >= 8) & F.get(t, 1).try_cast("int").isNotNull())
    value = lambda k: F.get("t", k).try_cast("double")
    out = poses.select(F.when(name != "", name).otherwise(stem(F.col("path"))).alias("name"), "pose_id", fps.alias("fps_score"), F.explode(rows).alias("t")).select(
        "name", "pose_id", "fps_score", F.upper(F.get("t", 0)).alias("residue_name"), F.get("t", 1).try_cast("int").alias("residue_number"), value(2).alias("ref_vdw"), value(3).alias("ref_es"),
        F.get("t", 4).try_cast("int").alias("hb_ref"), value(5).alias("vdw"), value(6).alias("es"), F.get("t", 7).try_cast("int").alias("hb_pose"),
    )
    out = out.filter("vdw is not null and es is not null")
    total = {"total": F.round(F.col("vdw") + F.col("es"), 6), "ref_total": F.round(F.col("ref_vdw") + F.col("ref_es"), 6), "delta_vdw": F.round(F.col("vdw") - F.col("ref_vdw"), 6), "delta_es": F.round(F.col("es") - F.col("ref_es"), 6)}
    out = out.withColumns(total).withColumn("delta_total", F.round(F.col("total") - F.col("ref_total"), 6))
    plain = F.format_string("%s%d.A", "residue_name", "residue_number")
    if mapping is None:
        return out.withColumn("residue_id", plain)
    named = out.join(mapping.select(F.col("seq_id").alias("__seq"), F.col("residue_id").alias("__id")), F.col("residue_number") == F.col("__seq"), "left")
    return named.withColumn("residue_id", F.coalesce("__id", plain)).drop("__seq", "__id")
