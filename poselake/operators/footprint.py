"""Per-residue energies: summaries, consistency, consensus, pharmacophore, zones and numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A footprint table has (name, pose_id, residue_id, vdw, es, total, ref_vdw, ref_es, ref_total); rows without name or residue are left out.


def _known(df: DataFrame) -> DataFrame:
    return df.filter("name is not null and residue_id is not null")


def pose_summary(df: DataFrame, cutoff: float = -0.5) -> DataFrame:
    """Sums and residue counts of every pose; contributing residues have ``total < cutoff``."""
    return _known(df).groupBy("name", "pose_id").agg(
        F.sum("vdw").alias("total_vdw"), F.sum("es").alias("total_es"), F.sum("total").alias("total_energy"), F.count(F.lit(1)).alias("n_residues_total"), F.count_if(F.col("total") < cutoff).alias("n_residues_contributing")
    )


def best_pose_only(df: DataFrame, score: str = "fps_score") -> DataFrame:
    """Rows of each molecule's pose with the lowest score, chosen before anything is expanded."""
    best = df.filter(F.col(score).isNotNull()).groupBy("name").agg(F.min_by("pose_id", F.struct(score, "pose_id")).alias("pose_id"))
    return df.join(best, ["name", "pose_id"], "left_semi")


def consistency(df: DataFrame, favourable: float = 0.0) -> DataFrame:
    """(name, residue_id): energy statistics over the poses, and the share of the molecule's poses that favour the residue.

    Molecules with one pose are left out. The standard deviation is the population's. Distinct poses are
    counted by (name, pose) first, so a molecule with very many rows is spread over its poses.
    """
    ok = _known(df)
    n_poses = ok.groupBy("name").agg(F.countDistinct("pose_id").alias("n_poses")).filter("n_poses >= 2")
    per = ok.groupBy("name", "residue_id").agg(
        F.avg("total").alias("mean_total"), F.stddev_pop("total").alias("std_total"), F.min("total").alias("min_total"), F.max("total").alias("max_total"),
        F.avg("vdw").alias("mean_vdw"), F.avg("es").alias("mean_es"), F.count_if(F.col("total") < favourable).alias("n_favorable"),
    )
    return per.join(n_poses, "name").withColumn("consistency", F.col("n_favorable") / F.col("n_poses"))


def weighted_consistency(per_residue: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Consistency of a molecule, weighted by the mean energy of its significant residues; 0 without any."""
    size = F.abs("mean_total")
    significant = (size > threshold) & (F.col("mean_total") < 0)
    weight = F.sum(F.when(significant, size))
    return per_residue.groupBy("name").agg(
        F.coalesce(F.sum(F.when(significant, size * F.col("consistency"))) / weight, F.lit(0.0)).alias("weighted_consistency"),
        F.count_if(significant).alias("n_significant"), F.count_if(significant & (F.col("consistency") > 0.5)).alias("n_consistent"),
    )


def residue_consensus(df: DataFrame, cutoff: float = -0.5) -> DataFrame:
    """Residues over all poses of all molecules: who has them, who gains by them, mean energies and the reference.

    The standard deviation is the sample's, 0 for a single row. The reference is that of the first (name,
    pose). Shares are of all molecules.
    """
    ok = _known(df)
    n_all = ok.agg(F.countDistinct("name").alias("n_all"))
    first = F.min_by(F.struct("ref_vdw", "ref_es"), F.struct("name", "pose_id", "total", "ref_vdw", "ref_es"))
    per = ok.groupBy("residue_id").agg(
        F.countDistinct("name").alias("n_molecules"), F.countDistinct(F.when(F.col("total") < cutoff, F.col("name"))).alias("n_contributing"),
        F.avg("vdw").alias("mean_vdw"), F.avg("es").alias("mean_es"), F.avg("total").alias("mean_total"), F.coalesce(F.stddev_samp("total"), F.lit(0.0)).alias("std_total"),
        F.min("total").alias("min_total"), F.max("total").alias("max_total"),
    )
    refs = ok.groupBy("residue_id").agg(first.alias("f")).select("residue_id", "f.ref_vdw", "f.ref_es")
    out = per.join(refs, "residue_id").crossJoin(F.broadcast(n_all))  # n_all: one row
    return out.withColumns({"frac_present": F.col("n_molecules") / F.col("n_all"), "frac_contributing": F.col("n_contributing") / F.col("n_all")}).drop("n_all")


def pharmacophore(consensus: DataFrame, least: float = 0.8) -> DataFrame:
    """Residues that at least ``least`` of the molecules gain by, strongest first."""
    return consensus.filter(F.col("frac_contributing") >= least).orderBy("mean_total", "residue_id")


def reference_deltas(df: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows whose total differs from the reference's by more than ``least``, with the differences."""
    out = _known(df).withColumns({"delta_vdw": F.col("vdw") - F.col("ref_vdw"), "delta_es": F.col("es") - F.col("ref_es"), "delta_total": F.col("total") - F.col("ref_total")})
    return out.filter(F.abs("delta_total") > least)


def zone_energies(consensus: DataFrame, zones: DataFrame, top: int = 5) -> DataFrame:
    """Energies summed by zone (``zones``: residue_id, zone_label), its strongest residues first in a list."""
    placed = consensus.join(zones.select("residue_id", "zone_label"), "residue_id", "left").withColumn("zone_label", F.coalesce("zone_label", F.lit("other")))
    sums = placed.groupBy("zone_label").agg(F.count(F.lit(1)).alias("n_residues"), F.sum("mean_total").alias("sum_total"), F.sum("mean_vdw").alias("sum_vdw"), F.sum("mean_es").alias("sum_es"))
    rank = F.row_number().over(Window.partitionBy("zone_label").orderBy("mean_total", "residue_id"))
    lists = placed.withColumn("k", rank).filter(F.col("k") <= top).groupBy("zone_label").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "residue_id"))), lambda x: x["residue_id"]).alias("strongest"))
    return sums.join(lists, "zone_label")


def numbering_map(substructures: DataFrame, residues: DataFrame, mismatches: float = 0.10) -> DataFrame:
    """(seq_id, residue_id): two residue lists paired by their order; empty if lengths differ or more than a tenth of the names do.

    ``substructures``: (seq_id, resname); ``residues``: (ordinal, resname, resid, chain). Both describe one
    receptor, some thousand rows at most, so a single window over each is fine.
    """
    left = substructures.select("seq_id", F.upper("resname").alias("a"), F.row_number().over(Window.orderBy("seq_id")).alias("k"))
    right = residues.select(F.upper("resname").alias("b"), "resid", "chain", F.row_number().over(Window.orderBy("ordinal")).alias("k"))
    both = left.join(right, "k", "full_outer")
    fits = both.agg((F.count_if(F.col("a").isNull() | F.col("b").isNull()) == 0).alias("equal"), F.avg((F.substring("a", 1, 3) != F.col("b")).cast("int")).alias("off"))
    return both.crossJoin(F.broadcast(fits)).filter(F.col("equal") & (F.col("off") <= mismatches)).select("seq_id", F.format_string("%s%d.%s", "b", "resid", "chain").alias("residue_id"))  # fits: one row


def renumbered(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Footprint rows (resname, resid) with the mapped ``residue_id``, or ``RESn.A`` where there is no mapping."""
    named = df.join(mapping.withColumnRenamed("residue_id", "__mapped"), df.resid == mapping.seq_id, "left")
    return named.withColumn("residue_id", F.coalesce("__mapped", F.format_string("%s%d.A", F.upper("resname"), F.col("resid").cast("int")))).drop("__mapped", "seq_id")
