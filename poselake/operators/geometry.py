"""Coordinates: distances, boxes, contacts by a grid join, poses against poses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

XYZ = ("x", "y", "z")


def squared_distance(a: Column, b: Column) -> Column:
    """Sum of squared differences of two arrays of numbers; null if their sizes differ."""
    total = F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d)
    return F.when(F.size(a) == F.size(b), total)


def rmsd(a: Column, b: Column) -> Column:
    """RMSD of two conformations, each an array of (x, y, z) arrays, without superposition.

    Null if the atom counts differ or are zero.
    """
    total = F.aggregate(F.zip_with(a, b, squared_distance), F.lit(0.0), lambda s, d: s + d)
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), F.sqrt(total / F.size(a)))


def spatial_join(left: DataFrame, right: DataFrame, cutoff: float, inclusive: bool = True, on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of rows at most (or less than) ``cutoff`` apart, as an equi-join on grid cells.

    Both sides have x, y, z; columns of ``right`` come out with the prefix ``r_``, and ``d2`` is the squared
    distance. Space is cut into cells of ``cutoff``; each left row looks into the 27 cells around its own,
    so every pair meets in exactly one of them, and the exact distance decides. ``on`` names columns that
    must be equal. Rows without three coordinates match nothing. Spark broadcasts the right side only if it
    knows it to be small; else both sides are exchanged by cell.
    """
    a = left.dropna(subset=list(XYZ))
    for c in XYZ:
        a = a.withColumn(f"__{c}", F.explode(F.array(*[F.floor(F.col(c) / cutoff) + i for i in (-1, 0, 1)])))
    b = right.dropna(subset=list(XYZ)).select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).withColumns({f"__{c}": F.floor(F.col(f"r_{c}") / cutoff) for c in XYZ})
    by = [a[f"__{c}"] == b[f"__{c}"] for c in XYZ] + [a[c] == b[f"r_{c}"] for c in on]
    condition = by[0]
    for c in by[1:]:
        condition = condition & c
    d2 = (F.col("x") - F.col("r_x")) ** 2 + (F.col("y") - F.col("r_y")) ** 2 + (F.col("z") - F.col("r_z")) ** 2
    near = F.col("d2") <= cutoff * cutoff if inclusive else F.col("d2") < cutoff * cutoff
    return a.join(b, condition).withColumn("d2", d2).filter(near).drop(*[a[f"__{c}"] for c in XYZ], *[b[f"__{c}"] for c in XYZ])


def residue_contacts(ligand: DataFrame, receptor: DataFrame, by: tuple[str, ...], cutoff: float = 4.5, count: str = "receptor_atoms", inclusive: bool = True) -> DataFrame:
    """Contacts of ligands with residues: (by..., r_residue_id, min_distance, n_atom_contacts, closest_receptor_atom, closest_ligand_atom).

    ``ligand``: (by..., atom, x, y, z); ``receptor``: (residue_id, atom, ord, x, y, z). ``count`` is
    ``receptor_atoms`` (atoms of the residue within reach) or ``atom_pairs``. Equal distances go to the first receptor atom.
    """
    pairs = spatial_join(ligand, receptor, cutoff, inclusive)
    n = F.countDistinct("r_ord") if count == "receptor_atoms" else F.count(F.lit(1))
    closest = F.min(F.struct("d2", "r_ord", "r_atom", "atom"))
    out = pairs.groupBy(*by, "r_residue_id").agg(closest.alias("c"), n.alias("n_atom_contacts"))
    return out.select(*by, F.col("r_residue_id").alias("residue_id"), F.sqrt("c.d2").alias("min_distance"), "n_atom_contacts", F.col("c.r_atom").alias("closest_receptor_atom"), F.col("c.atom").alias("closest_ligand_atom"))


def centroid(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean of the coordinates."""
    return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in XYZ])


def bounding_box(df: DataFrame, padding: float = 6.0, least: float = 10.0, by: tuple[str, ...] = ()) -> DataFrame:
    """Axis-aligned box: centre (min + max) / 2, size max - min + 2 * padding but ``least`` at least, and its volume."""
    ends = df.groupBy(*by).agg(*[f(c).alias(f"{n}_{c}") for c in XYZ for n, f in (("lo", F.min), ("hi", F.max))])
    size = {c: F.greatest(F.col(f"hi_{c}") - F.col(f"lo_{c}") + 2 * padding, F.lit(least)) for c in XYZ}
    out = ends.select(*by, *[((F.col(f"lo_{c}") + F.col(f"hi_{c}")) / 2).alias(f"center_{c}") for c in XYZ], *[size[c].alias(f"size_{c}") for c in XYZ])
    return out.withColumn("volume", F.col("size_x") * F.col("size_y") * F.col("size_z"))


def residue_centroids(atoms: DataFrame) -> DataFrame:
    """One point per residue: its CA atom, else its first atom."""
    pick = F.min_by(F.struct(*XYZ), F.struct((F.col("atom") != "CA").cast("int"), F.col("ord")))
    return atoms.groupBy("residue_id").agg(pick.alias("p")).select("residue_id", "p.x", "p.y", "p.z")


def within_radius(atoms: DataFrame, centre: tuple[float, float, float], radius: float = 25.0) -> DataFrame:
    """Whole residues with at least one atom inside the sphere."""
    d2 = sum(((F.col(c) - v) ** 2 for c, v in zip(XYZ[1:], centre[1:])), (F.col("x") - centre[0]) ** 2)
    inside = atoms.filter(d2 <= radius * radius).select("residue_id").distinct()
    return atoms.join(inside, "residue_id", "left_semi")


def pose_pairs(poses: DataFrame, by: str = "name", pose: str = "pose_index", coords: str = "coords") -> DataFrame:
    """(by, pose_a, pose_b, rmsd) of the pairs pose_a < pose_b of one molecule; atom counts that differ give null.

    The full matrix is the result: poses of one molecule are some hundreds at most, as docking engines write them.
    """
    a, b = poses.select(by, F.col(pose).alias("pose_a"), F.col(coords).alias("__a")), poses.select(by, F.col(pose).alias("pose_b"), F.col(coords).alias("__b"))
    return a.join(b, by).filter("pose_a < pose_b").select(by, "pose_a", "pose_b", rmsd(F.col("__a"), F.col("__b")).alias("rmsd"))


def binding_modes(poses: DataFrame, by: str = "name", pose: str = "pose_index", score: str = "score", coords: str = "coords") -> tuple[DataFrame, DataFrame]:
    """(detail, summary): per pose its mean and least RMSD to the others; per molecule the scores' statistics and RMSD.

    The standard deviation is the population's; a single pose has null RMSD figures.
    """
    pairs = pose_pairs(poses, by, pose, coords)
    sides = pairs.select(by, F.explode(F.array("pose_a", "pose_b")).alias(pose), "rmsd")
    detail = poses.select(by, pose, score).join(sides.groupBy(by, pose).agg(F.avg("rmsd").alias("mean_rmsd"), F.min("rmsd").alias("min_rmsd")), [by, pose], "left")
    stats = poses.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_modes"), F.min(score).alias("best_score"), F.max(score).alias("worst_score"), F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"),
        F.min_by(pose, F.struct(score, pose)).alias("best_pose"),
    ).withColumn("spread", F.col("worst_score") - F.col("best_score"))
    summary = stats.join(pairs.groupBy(by).agg(F.avg("rmsd").alias("mean_rmsd"), F.max("rmsd").alias("max_rmsd")), by, "left")
    return detail, summary


def reference_rmsd(poses: DataFrame, reference: Column, by: str = "name", pose: str = "pose_index", coords: str = "coords") -> DataFrame:
    """Re-docking check: RMSD of every pose to the reference over their common length, summed up per molecule."""
    n = F.least(F.size(coords), F.size(reference))
    d = rmsd(F.slice(F.col(coords), 1, n), F.slice(reference, 1, n))
    return poses.withColumn("rmsd", d).filter("rmsd is not null").groupBy(by).agg(
        F.count(F.lit(1)).alias("n_poses"), F.min("rmsd").alias("best_rmsd"), F.min_by(pose, F.struct("rmsd", pose)).alias("best_pose"), F.avg("rmsd").alias("mean_rmsd"),
        F.median("rmsd").alias("median_rmsd"), F.max("rmsd").alias("worst_rmsd"), F.count_if(F.col("rmsd") < 2.0).alias("n_below_2"), F.avg((F.col("rmsd") < 2.0).cast("int")).alias("frac_below_2"), F.count_if(F.col("rmsd") < 3.0).alias("n_below_3"),
    )
