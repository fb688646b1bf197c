"""Which structures stand for a molecule: centroids of its clusters, medoids, consensus poses and sweet spots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fragments import fragment_centroids, medoids, selected_structures, sweet_spots


def cluster_centroids(atoms: DataFrame, fragment_atoms: DataFrame, pairs: DataFrame, labels: DataFrame, dominant: DataFrame, every: bool = False, least: float = 0.15) -> DataFrame:
    """(name, fragment_id, cluster, pose_index, x, y, z, n_atoms, cluster_size, dominant_fraction): a fragment's centroid in its clusters' medoid poses.

    Of the dominant cluster only, or of ``every`` cluster that holds at least ``least`` of the poses or is dominant. Noise has no centroid.
    """
    sized = medoids(pairs, labels).join(dominant.select("name", "fragment_id", "n_poses", "dominant_cluster"), ["name", "fragment_id"])
    share = F.col("size") / F.col("n_poses")
    own = F.col("cluster") == F.col("dominant_cluster")
    kept = sized.filter(own | (share >= least) if every else own).select("name", "fragment_id", "cluster", "pose_index", F.col("size").alias("cluster_size"), share.alias("dominant_fraction"))
    placed = fragment_centroids(atoms, fragment_atoms, kept.select("name", "fragment_id", "cluster", "pose_index"))
    return placed.join(kept, ["name", "fragment_id", "cluster", "pose_index"])


def dominant_rmsd(pairs: DataFrame, labels: DataFrame, dominant: DataFrame) -> DataFrame:
    """``dominant`` with ``dominant_rmsd``, the mean pairwise RMSD inside the dominant cluster; 0 for a single pose or none."""
    own = labels.join(dominant.select("name", "fragment_id", "dominant_cluster"), ["name", "fragment_id"]).filter("cluster >= 0 and cluster = dominant_cluster")
    a, b = (own.select("name", "fragment_id", F.col("pose_index").alias(p)) for p in ("pose_a", "pose_b"))
    inside = pairs.join(a, ["name", "fragment_id", "pose_a"]).join(b, ["name", "fragment_id", "pose_b"])
    mean = inside.groupBy("name", "fragment_id").agg(F.avg("rmsd").alias("dominant_rmsd"))
    return dominant.join(mean, ["name", "fragment_id"], "left").fillna(0.0, ["dominant_rmsd"])


def export_selection(pairs: DataFrame, labels: DataFrame, dominant: DataFrame, scores: DataFrame, per_fragment: int = 3, spots: int = 3) -> DataFrame:
    """(name, label, pose_index): the poses to be written out.

    ``frag{f}_cl{c}``: medoids of the ``per_fragment`` largest clusters of each fragment. ``full_consensus``: of the poses whose
    every fragment lies in its dominant cluster, the one of least mean RMSD to the others by the lowest fragment. ``sweet{i}_{score}``: of the ``spots``
    label tuples of lowest mean score, the best pose each. ``scores`` holds one score per pose; equal ones go to the first pose.
    """
    parts = selected_structures(medoids(pairs, labels), per_fragment).select("name", F.format_string("frag%d_cl%d", "fragment_id", "cluster").alias("label"), "pose_index")
    own = labels.join(dominant.select("name", "fragment_id", "dominant_cluster"), ["name", "fragment_id"])
    agree = own.groupBy("name", "pose_index").agg(F.bool_and(F.col("cluster") == F.col("dominant_cluster")).alias("all"), F.min("fragment_id").alias("fragment_id")).filter("all")
    agree = agree.select("name", "fragment_id", "pose_index", F.lit(0).alias("cluster"))
    whole = medoids(pairs.join(agree.select("name", "fragment_id").distinct(), ["name", "fragment_id"], "left_semi"), agree).select("name", F.lit("full_consensus").alias("label"), "pose_index")
    tuples = labels.groupBy("name", "pose_index").agg(F.transform(F.sort_array(F.collect_list(F.struct("fragment_id", "cluster"))), lambda x: x["cluster"]).alias("labels"))
    sweet = sweet_spots(labels, scores, spots).select("name", "labels", "place")
    best = tuples.join(sweet, ["name", "labels"]).join(scores.filter("value is not null"), ["name", "pose_index"]).groupBy("name", "place", "score_key").agg(F.min_by("pose_index", F.struct("value", "pose_index")).alias("pose_index"))
    return parts.unionByName(whole).unionByName(best.select("name", F.format_string("sweet%d_%s", "place", "score_key").alias("label"), "pose_index"))


def named_by_hotspot(selection: DataFrame, members: DataFrame) -> DataFrame:
    """Labels of fragment structures with ``_H{hotspot}`` where the cluster is a member of one; ``members``: (name, fragment_id, cluster, hotspot)."""
    tags = members.select("name", F.format_string("frag%d_cl%d", "fragment_id", "cluster").alias("label"), F.format_string("_H%d", "hotspot").alias("__tag"))
    tags = tags.groupBy("name", "label").agg(F.min("__tag").alias("__tag"))
    return selection.join(tags, ["name", "label"], "left").withColumn("label", F.concat("label", F.coalesce("__tag", F.lit("")))).drop("__tag")
