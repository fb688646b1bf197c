"""Fragments of docked molecules: energies, pose clusters, convergence, sweet spots and composite scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import sequential_rank, top_per_group

TERMS = ("gauss1", "gauss2", "repulsion", "hydrophobic", "hbond")


def fragment_energies(atom_terms: DataFrame, fragment_atoms: DataFrame, affinities: DataFrame, terms: Sequence[str] = TERMS) -> DataFrame:
    """Energy of every (name, fragment_id) over its poses, and its proportional part of the molecule's affinity.

    ``atom_terms``: (name, pose_index, atom_index, terms...), already weighted; ``fragment_atoms``: (name,
    fragment_id, atom_index); ``affinities``: (name, pose_index, vina). Terms are summed by atom and by fragment
    and pose; then mean, population deviation, best and the mean of each term follow. The proportional
    energy is vina * |fragment| / sum of |fragments| of the pose (0 where the sum is below 1e-10).
    """
    total = sum((F.col(t) for t in terms[1:]), F.col(terms[0]))
    per_pose = atom_terms.join(fragment_atoms, ["name", "atom_index"]).groupBy("name", "pose_index", "fragment_id").agg(F.sum(total).alias("energy"), *[F.sum(t).alias(t) for t in terms])
    whole = F.sum(F.abs("energy")).over(Window.partitionBy("name", "pose_index"))
    share = F.when(whole >= 1e-10, F.abs("energy") / whole).otherwise(0.0)
    per_pose = per_pose.withColumn("share", share).join(affinities, ["name", "pose_index"], "left").withColumn("proportional", F.col("vina") * F.col("share"))
    return per_pose.groupBy("name", "fragment_id").agg(
        F.avg("energy").alias("vina_mean"), F.stddev_pop("energy").alias("vina_std"), F.min("energy").alias("vina_best"), F.max("energy").alias("vina_worst"),
        *[F.avg(t).alias(f"{t}_contrib") for t in terms],
        F.avg("proportional").alias("proportional_vina_mean"), F.stddev_pop("proportional").alias("proportional_vina_std"), F.min("proportional").alias("proportional_vina_best"), F.avg("share").alias("proportion_of_total"),
    )


def cluster_scores(labels: DataFrame, scores: DataFrame) -> DataFrame:
    """(name, fragment_id, cluster, score_key): mean, best (least), worst and population deviation; noise (-1) and null scores left out."""
    joined = labels.filter("cluster >= 0").join(scores.filter("value is not null"), ["name", "pose_index"])
    return joined.groupBy("name", "fragment_id", "cluster", "score_key").agg(F.avg("value").alias("mean"), F.min("value").alias("best"), F.max("value").alias("worst"), F.stddev_pop("value").alias("std"), F.count(F.lit(1)).alias("n"))


def dominant_clusters(labels: DataFrame, least: float = 0.15) -> DataFrame:
    """Per (name, fragment_id): largest cluster (lowest label on ties), its share of all poses, noise, sizes in descending order.

    ``labels``: (name, fragment_id, pose_index, cluster), -1 for noise. Without a cluster the dominant one
    is -1 with size and share 0. ``low_confidence``: the share is below ``least``.
    """
    sizes = labels.groupBy("name", "fragment_id", "cluster").agg(F.count(F.lit(1)).alias("n"))
    real = F.col("cluster") >= 0
    best = F.max(F.when(real, F.struct(F.col("n"), -F.col("cluster"))))
    out = sizes.groupBy("name", "fragment_id").agg(
        F.sum("n").alias("n_poses"), F.count_if(real).alias("n_clusters"), best.alias("b"), F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)).alias("n_noise"),
        F.sort_array(F.collect_list(F.when(real, F.col("n"))), asc=False).alias("sizes"),
    )
    out = out.withColumns({"dominant_cluster": F.coalesce(-F.col("b.col2"), F.lit(-1)), "dominant_size": F.coalesce("b.n", F.lit(0))}).drop("b")
    out = out.withColumns({"dominant_fraction": F.col("dominant_size") / F.col("n_poses"), "noise_fraction": F.col("n_noise") / F.col("n_poses")})
    return out.withColumn("low_confidence", F.col("dominant_fraction") < least)


def sweet_spots(labels: DataFrame, scores: DataFrame, k: int = 10) -> DataFrame:
    """Label tuples of poses without noise: how often, mean, best, population deviation; the ``k`` lowest means per molecule.

    A molecule's poses are grouped by the labels of all its fragments in order of fragment_id.
    """
    tuples = labels.groupBy("name", "pose_index").agg(F.transform(F.sort_array(F.collect_list(F.struct("fragment_id", "cluster"))), lambda x: x["cluster"]).alias("labels"))
    clean = tuples.filter(~F.exists("labels", lambda x: x < 0)).join(scores.filter("value is not null"), ["name", "pose_index"])
    spots = clean.groupBy("name", "labels").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.min("value").alias("best"), F.stddev_pop("value").alias("std"))
    return top_per_group(spots, ["name"], [F.col("mean").asc(), F.col("labels").asc()], k)


def full_consensus(labels: DataFrame, dominant: DataFrame, scores: DataFrame) -> DataFrame:
    """Per molecule: poses whose every fragment lies in its dominant cluster, their mean and best, and the mean of the rest."""
    own = labels.join(dominant.select("name", "fragment_id", "dominant_cluster"), ["name", "fragment_id"])
    whole = own.groupBy("name", "pose_index").agg(F.bool_and(F.col("cluster") == F.col("dominant_cluster")).alias("whole"))
    joined = whole.join(scores, ["name", "pose_index"])
    return joined.groupBy("name").agg(F.count_if("whole").alias("n_consensus"), F.avg(F.when(F.col("whole"), F.col("value"))).alias("mean_consensus"), F.min(F.when(F.col("whole"), F.col("value"))).alias("best_consensus"), F.avg(F.when(~F.col("whole"), F.col("value"))).alias("mean_other"))


def weighted_convergence(fragments: DataFrame, weight: str = "weight", convergence: str = "dominant_fraction", name: str = "name", label: str = "fragment_label") -> DataFrame:
    """Convergence of a molecule's fragments weighted by |weight| (plain mean if all are 0), the least, and the fragment of lowest weight * convergence."""
    w, c = F.abs(weight), F.col(convergence)
    total = F.sum(w)
    best = F.min_by(F.concat(F.col(label), F.lit(" ("), F.format_number(c, 2), F.lit(")")), F.struct((F.col(weight) * c).alias("p"), F.col(label)))
    return fragments.groupBy(name).agg(F.when(total > 0, F.sum(c * w) / total).otherwise(F.avg(c)).alias("weighted_convergence"), F.min(c).alias("min_convergence"), best.alias("best_fragment"), F.count(F.lit(1)).alias("n_fragments"))


def composite_ranking(convergence: DataFrame, affinities: DataFrame, name: str = "name", vina: str = "vina_affinity") -> DataFrame:
    """Composite score vina * weighted convergence, ranked ascending; molecules without affinity are left out."""
    out = affinities.filter(F.col(vina).isNotNull()).join(convergence, name).withColumn("composite_score", F.col(vina) * F.col("weighted_convergence"))
    return sequential_rank(out, [F.col("composite_score").asc_nulls_last(), F.col(name).asc()])


def fragment_centroids(atoms: DataFrame, fragment_atoms: DataFrame, medoids: DataFrame) -> DataFrame:
    """Mean position of a fragment's atoms in its cluster's medoid pose.

    ``medoids``: (name, fragment_id, cluster, pose_index).
    """
    placed = medoids.join(fragment_atoms, ["name", "fragment_id"]).join(atoms, ["name", "pose_index", "atom_index"])
    return placed.groupBy("name", "fragment_id", "cluster", "pose_index").agg(*[F.avg(c).alias(c) for c in ("x", "y", "z")], F.count(F.lit(1)).alias("n_atoms"))


def medoids(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per cluster the pose of least mean RMSD to its members (itself included as 0), the first on ties.

    ``pairs``: (name, fragment_id, pose_a, pose_b, rmsd) with pose_a < pose_b.
    """
    both = pairs.unionByName(pairs.select("name", "fragment_id", F.col("pose_b").alias("pose_a"), F.col("pose_a").alias("pose_b"), "rmsd"))
    real = labels.filter("cluster >= 0")
    a = real.select("name", "fragment_id", F.col("pose_index").alias("pose_a"), "cluster")
    b = real.select("name", "fragment_id", F.col("pose_index").alias("pose_b"), F.col("cluster").alias("cluster_b"))
    inside = both.join(a, ["name", "fragment_id", "pose_a"]).join(b, ["name", "fragment_id", "pose_b"]).filter("cluster = cluster_b")
    sums = a.join(inside.groupBy("name", "fragment_id", "pose_a").agg(F.sum("rmsd").alias("s")), ["name", "fragment_id", "pose_a"], "left")
    return sums.groupBy("name", "fragment_id", "cluster").agg(F.min_by("pose_a", F.struct(F.coalesce("s", F.lit(0.0)), F.col("pose_a"))).alias("pose_index"), F.count(F.lit(1)).alias("size"))


def selected_structures(medoid_poses: DataFrame, per_fragment: int = 3) -> DataFrame:
    """Medoids of the largest clusters of each fragment: what is exported as structures."""
    return top_per_group(medoid_poses, ["name", "fragment_id"], [F.col("size").desc(), F.col("cluster").asc()], per_fragment)


def hotspot_statistics(members: DataFrame, hotspot: str = "hotspot") -> DataFrame:
    """Hotspots by centre, radius, distinct molecules and fragments' properties, numbered by molecules.

    ``members``: (hotspot, name, x, y, z, is_ring, dominant_fraction, score_contribution). Contributions of 0
    don't count; without any others the figures are 0. The number follows n_molecules descending, then the hotspot's own.
    """
    centre = members.groupBy(hotspot).agg(*[F.avg(c).alias(f"c{c}") for c in ("x", "y", "z")])
    far = F.sqrt((F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2 + (F.col("z") - F.col("cz")) ** 2)
    some = F.when(F.col("score_contribution") != 0, F.col("score_contribution"))
    out = members.join(centre, hotspot).groupBy(hotspot, "cx", "cy", "cz").agg(
        F.max(far).alias("radius"), F.countDistinct("name").alias("n_molecules"), F.count(F.lit(1)).alias("n_fragments"), F.avg(F.col("is_ring").cast("int")).alias("ring_fraction"),
        F.avg("dominant_fraction").alias("mean_dominant_fraction"), F.coalesce(F.avg(some), F.lit(0.0)).alias("mean_score_contribution"), F.coalesce(F.min(some), F.lit(0.0)).alias("best_score_contribution"),
    )
    return sequential_rank(out, [F.col("n_molecules").desc(), F.col(hotspot).asc()], "number").withColumn("number", F.col("number") - 1)
