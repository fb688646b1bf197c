"""Distances, boxes, contacts from coordinates, poses against poses, density clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import contact_class
from ..operators import dbscan as D
from ..operators import geometry as G
from ..operators.latest import finite
from . import tables as T
from .sql import LATEST_OK, r

ATOMS = 21


def _centroids(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    df = T.latest(spark, sf, "fragment_centroids", "campaign_id", "molecule_name", "centroid", *columns).filter(F.size("centroid") == 3)
    return df.withColumns({c: finite(F.get("centroid", i)) for i, c in enumerate(G.XYZ)}).drop("centroid").dropna(subset=list(G.XYZ))


def _receptor(spark: SparkSession, sf: str) -> DataFrame:
    df = T.raw(spark, sf, "receptor_residues", "residue_id", "ordinal", "ca_x", "ca_y", "ca_z")
    return df.select("residue_id", F.lit("CA").alias("atom"), F.col("ordinal").alias("ord"), F.col("ca_x").alias("x"), F.col("ca_y").alias("y"), F.col("ca_z").alias("z"))


def _conformations(spark: SparkSession, sf: str) -> DataFrame:
    """(name, pose_index, score, coords): vectors read as conformations of 21 atoms."""
    v = T.raw(spark, sf, "embeddings", "vec_id", "embedding", "label")
    atoms = F.transform(F.sequence(F.lit(0), F.lit(ATOMS - 1)), lambda i: F.transform(F.slice("embedding", i * 3 + 1, F.lit(3)), lambda x: x.cast("double")))
    return v.select(F.col("label").alias("name"), F.col("vec_id").alias("pose_index"), F.get("embedding", 63).cast("double").alias("score"), atoms.alias("coords"))


def distance_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """Residues within 4.5 Å of a molecule's fragments: fragments are the ligand's atoms, CAs the receptor's."""
    ligand = _centroids(spark, sf).withColumn("atom", F.col("centroid_id"))
    out = G.residue_contacts(ligand, _receptor(spark, sf), ("molecule_name",), 4.5, count="atom_pairs", inclusive=True)
    return r(out.withColumn("contact_type", contact_class(F.round("min_distance", 6))), "min_distance").select("molecule_name", "residue_id", "min_distance", "n_atom_contacts", "contact_type")


def receptor_atom_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """The same by distinct receptor atoms, strictly within 5 Å."""
    ligand = _centroids(spark, sf).withColumn("atom", F.col("centroid_id"))
    return G.residue_contacts(ligand, _receptor(spark, sf), ("campaign_id",), 5.0, count="receptor_atoms", inclusive=False).select("campaign_id", "residue_id", "n_atom_contacts")


def binding_box(spark: SparkSession, sf: str) -> DataFrame:
    return r(G.bounding_box(_centroids(spark, sf), by=("campaign_id",)), "volume", *[f"{k}_{c}" for k in ("center", "size") for c in G.XYZ], digits=6)


def campaign_centroid(spark: SparkSession, sf: str) -> DataFrame:
    return r(G.centroid(_centroids(spark, sf), ("campaign_id",)), *G.XYZ)


def residue_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return G.residue_centroids(_receptor(spark, sf))


def trimmed_receptor(spark: SparkSession, sf: str) -> DataFrame:
    return G.within_radius(_receptor(spark, sf), (5.0, 0.0, 0.0), 12.0).select("residue_id", "ord")


def pair_rmsd(spark: SparkSession, sf: str) -> DataFrame:
    return r(G.pose_pairs(_conformations(spark, sf)), "rmsd")


def binding_mode_detail(spark: SparkSession, sf: str) -> DataFrame:
    return r(G.binding_modes(_conformations(spark, sf))[0], "mean_rmsd", "min_rmsd")


def binding_mode_summary(spark: SparkSession, sf: str) -> DataFrame:
    return r(G.binding_modes(_conformations(spark, sf))[1], "mean_score", "std_score", "spread", "mean_rmsd", "max_rmsd")


def redocking(spark: SparkSession, sf: str) -> DataFrame:
    zero = F.array(*[F.array(*[F.lit(0.0)] * 3)] * ATOMS)
    return r(G.reference_rmsd(_conformations(spark, sf), zero), "best_rmsd", "mean_rmsd", "median_rmsd", "worst_rmsd", "frac_below_2")


def hotspot_dbscan(spark: SparkSession, sf: str) -> DataFrame:
    """Density clusters of the fragment centroids of each campaign (2 Å, three positions)."""
    return D.dbscan_positions(_centroids(spark, sf), "centroid_id", 2.0, 3, ("campaign_id",)).filter("campaign_id is not null")


def pose_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """DBSCAN of conformations by RMSD within each molecule."""
    poses = _conformations(spark, sf).withColumn("fragment_id", F.lit(0))
    return D.cluster_poses(poses.select("name", "fragment_id", "pose_index", "coords"), eps=0.15, least=4)


QUERIES = [distance_contacts, receptor_atom_contacts, binding_box, campaign_centroid, residue_centroids, trimmed_receptor, pair_rmsd, binding_mode_detail, binding_mode_summary, redocking, hotspot_dbscan, pose_clusters]

_C = f"l AS ({LATEST_OK('fragment_centroids', ['centroid_id'])}), c AS (SELECT centroid_id, campaign_id, molecule_name, centroid[1] AS x, centroid[2] AS y, centroid[3] AS z FROM l WHERE len(centroid) = 3 AND isfinite(centroid[1]) AND isfinite(centroid[2]) AND isfinite(centroid[3]))"
_D2 = "(x - ca_x) ** 2 + (y - ca_y) ** 2 + (z - ca_z) ** 2"
_V = "v AS (SELECT label AS name, vec_id AS pose_index, CAST(embedding[64] AS DOUBLE) AS score, list_transform(embedding[1:63], lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)"
_PAIRS = _V + ", p AS (SELECT a.name, a.pose_index AS pose_a, b.pose_index AS pose_b, sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda t: (t[1] - t[2]) ** 2)) / 21) AS rmsd FROM v a JOIN v b ON a.name = b.name AND a.pose_index < b.pose_index), s AS (SELECT name, pose_a AS pose_index, rmsd FROM p UNION ALL SELECT name, pose_b, rmsd FROM p)"
SQL = {
    "distance_contacts": f"""WITH {_C}, p AS (SELECT molecule_name, residue_id, {_D2} AS d2 FROM c, receptor_residues WHERE {_D2} <= 4.5 * 4.5),
g AS (SELECT molecule_name, residue_id, sqrt(min(d2)) AS d, count(*) AS n_atom_contacts FROM p GROUP BY 1, 2)
SELECT molecule_name, residue_id, round(d, @9) AS min_distance, n_atom_contacts, CASE WHEN round(d, 6) < 2.5 THEN 'strong_hbond' WHEN round(d, 6) < 3.5 THEN 'hbond' WHEN round(d, 6) < 4.5 THEN 'vdw' ELSE 'weak' END AS contact_type FROM g""",
    "receptor_atom_contacts": f"WITH {_C} SELECT campaign_id, residue_id, count(DISTINCT ordinal) AS n_atom_contacts FROM c, receptor_residues WHERE {_D2} < 25 GROUP BY 1, 2",
    "binding_box": f"WITH {_C}, b AS (SELECT campaign_id, " + ", ".join(f"(min({a}) + max({a})) / 2 AS center_{a}, greatest(max({a}) - min({a}) + 12, 10) AS size_{a}" for a in "xyz") + " FROM c GROUP BY 1) SELECT campaign_id, " + ", ".join(f"round({k}_{a}, @6) AS {k}_{a}" for a in "xyz" for k in ("center", "size")) + ", round(size_x * size_y * size_z, @6) AS volume FROM b",
    "campaign_centroid": f"WITH {_C} SELECT campaign_id, round(avg(x), @9) AS x, round(avg(y), @9) AS y, round(avg(z), @9) AS z FROM c GROUP BY 1",
    "residue_centroids": "SELECT residue_id, ca_x AS x, ca_y AS y, ca_z AS z FROM receptor_residues",
    "trimmed_receptor": "SELECT residue_id, ordinal AS ord FROM receptor_residues WHERE (ca_x - 5) ** 2 + ca_y ** 2 + ca_z ** 2 <= 144",
    "pair_rmsd": f"WITH {_PAIRS} SELECT name, pose_a, pose_b, round(rmsd, @9) AS rmsd FROM p",
    "binding_mode_detail": f"WITH {_PAIRS} SELECT v.name, v.pose_index, v.score, round(avg(rmsd), @9) AS mean_rmsd, round(min(rmsd), @9) AS min_rmsd FROM v LEFT JOIN s USING (name, pose_index) GROUP BY 1, 2, 3",
    "binding_mode_summary": f"""WITH {_PAIRS}, a AS (SELECT name, count(*) AS n_modes, min(score) AS best_score, max(score) AS worst_score, round(avg(score), @9) AS mean_score, round(stddev_pop(score), @9) AS std_score, round(max(score) - min(score), @9) AS spread, arg_min(pose_index, row(score, pose_index)) AS best_pose FROM v GROUP BY 1),
b AS (SELECT name, round(avg(rmsd), @9) AS mean_rmsd, round(max(rmsd), @9) AS max_rmsd FROM p GROUP BY 1) SELECT * FROM a LEFT JOIN b USING (name)""",
    "redocking": f"""WITH {_V}, d AS (SELECT name, pose_index, sqrt(list_sum(list_transform(e, lambda x: x * x)) / 21) AS rmsd FROM v)
SELECT name, count(*) AS n_poses, round(min(rmsd), @9) AS best_rmsd, arg_min(pose_index, row(rmsd, pose_index)) AS best_pose, round(avg(rmsd), @9) AS mean_rmsd, round(median(rmsd), @9) AS median_rmsd, round(max(rmsd), @9) AS worst_rmsd,
 count(*) FILTER (rmsd < 2) AS n_below_2, round(avg((rmsd < 2)::INT), @9) AS frac_below_2, count(*) FILTER (rmsd < 3) AS n_below_3 FROM d GROUP BY 1""",
    "hotspot_dbscan": f"""WITH RECURSIVE {_C}, n AS MATERIALIZED (SELECT a.campaign_id, a.centroid_id AS u, b.centroid_id AS v FROM c a JOIN c b ON a.campaign_id = b.campaign_id AND abs(a.x - b.x) <= 2.001 AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 4),
k AS MATERIALIZED (SELECT u FROM n GROUP BY 1 HAVING count(*) >= 3), e AS MATERIALIZED (SELECT u, v FROM n WHERE u IN (SELECT u FROM k) AND v IN (SELECT u FROM k)),
w(root, node) AS (SELECT u, u FROM k UNION SELECT w.root, e.v FROM w JOIN e ON e.u = w.node), g AS (SELECT node, min(root) AS cluster FROM w GROUP BY 1),
z AS (SELECT n.u, min(g.cluster) AS cluster FROM n JOIN g ON g.node = n.v GROUP BY 1)
SELECT c.campaign_id, c.centroid_id, coalesce(g.cluster, z.cluster) AS cluster, g.cluster IS NOT NULL AS is_core FROM c LEFT JOIN g ON g.node = c.centroid_id LEFT JOIN z ON z.u = c.centroid_id WHERE c.campaign_id IS NOT NULL""",
    "pose_clusters": f"""WITH RECURSIVE {_V}, n AS MATERIALIZED (SELECT a.name, a.pose_index AS u, b.pose_index AS v FROM v a JOIN v b ON a.name = b.name
 WHERE sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda t: (t[1] - t[2]) ** 2)) / 21) <= 0.15), k AS MATERIALIZED (SELECT name, u FROM n GROUP BY 1, 2 HAVING count(*) >= 4),
e AS MATERIALIZED (SELECT n.* FROM n SEMI JOIN k USING (name, u) SEMI JOIN (SELECT name, u AS v FROM k) USING (name, v)),
w(name, root, node) AS (SELECT name, u, u FROM k UNION SELECT w.name, w.root, e.v FROM w JOIN e ON e.name = w.name AND e.u = w.node), g AS (SELECT name, node, min(root) AS root FROM w GROUP BY 1, 2),
o AS (SELECT name, root, dense_rank() OVER (PARTITION BY name ORDER BY root) - 1 AS c FROM (SELECT DISTINCT name, root FROM g)), z AS (SELECT n.name, n.u, min(o.c) AS c FROM n JOIN g ON g.name = n.name AND g.node = n.v JOIN o ON o.name = g.name AND o.root = g.root GROUP BY 1, 2)
SELECT v.name, 0 AS fragment_id, pose_index, coalesce(o.c, z.c, -1) AS cluster FROM v LEFT JOIN g ON g.name = v.name AND g.node = pose_index LEFT JOIN o ON o.name = g.name AND o.root = g.root LEFT JOIN z ON z.name = v.name AND z.u = pose_index""",
}
