"""Fragments: clusters, energies, convergence, sweet spots, regression, hotspots, contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import fragment_assessment, stability
from ..operators import contacts as K
from ..operators import dbscan as D
from ..operators import export as X
from ..operators import fragments as A
from ..operators import ranking as R
from ..operators import regression as O
from ..operators import structures as S
from ..operators.geometry import pose_pairs
from . import tables as T
from .footprint_queries import _CONTACTS
from .geometry_queries import _C, _V, _centroids, _conformations
from .rank_queries import _MERGED, _MOL, consensus_hits
from .sql import LATEST_OK, RANKING, r

# Surrogates from the star schema: labels of fragments in poses, scores of poses, atoms' energy terms.
def _labels(spark: SparkSession, sf: str) -> DataFrame:
    lines = T.raw(spark, sf, "lineitem", "l_suppkey", "l_linenumber", "l_orderkey", "l_partkey")
    by = [F.col("l_suppkey").alias("name"), (F.col("l_linenumber") % 4).cast("int").alias("fragment_id"), (F.col("l_orderkey") % 40).cast("int").alias("pose_index")]
    return lines.groupBy(*by).agg((F.sum("l_partkey") % 4 - 1).cast("int").alias("cluster"))


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    lines = T.raw(spark, sf, "lineitem", "l_suppkey", "l_orderkey", "l_extendedprice")
    return lines.groupBy(F.col("l_suppkey").alias("name"), (F.col("l_orderkey") % 40).cast("int").alias("pose_index")).agg((-F.min("l_extendedprice")).alias("value")).withColumn("score_key", F.lit("vina_affinity"))


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    lines = T.raw(spark, sf, "lineitem", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    by = [F.col("l_suppkey").alias("name"), (F.col("l_orderkey") % 40).cast("int").alias("pose_index"), F.col("l_linenumber").alias("atom_index")]
    out = lines.groupBy(*by).agg(F.min("l_quantity").alias("q"), F.min("l_discount").alias("d"), F.max("l_tax").alias("t"))
    return out.select("name", "pose_index", "atom_index", (-F.col("q") / 100).alias("gauss1"), (-F.col("d")).alias("gauss2"), F.col("t").alias("repulsion"), (-F.col("d") * 2).alias("hydrophobic"), F.lit(-0.01).alias("hbond"))


def _fragment_atoms(spark: SparkSession, sf: str) -> DataFrame:
    return T.raw(spark, sf, "lineitem", "l_suppkey", "l_linenumber").select(F.col("l_suppkey").alias("name"), (F.col("l_linenumber") % 3).cast("int").alias("fragment_id"), F.col("l_linenumber").alias("atom_index")).distinct()


def cluster_score_stats(spark: SparkSession, sf: str) -> DataFrame:
    return r(A.cluster_scores(_labels(spark, sf), _scores(spark, sf)), "mean", "std", digits=6)


def dominant_clusters(spark: SparkSession, sf: str) -> DataFrame:
    out = A.dominant_clusters(_labels(spark, sf), least=0.45).withColumn("sizes", F.concat_ws(",", F.transform("sizes", lambda x: x.cast("string"))))
    return r(out, "dominant_fraction", "noise_fraction")


def sweet_spots(spark: SparkSession, sf: str) -> DataFrame:
    out = A.sweet_spots(_labels(spark, sf), _scores(spark, sf), k=3).withColumn("labels", F.concat_ws(",", F.transform("labels", lambda x: x.cast("string"))))
    return r(out, "mean", "std", digits=6).drop("place")


def full_consensus_poses(spark: SparkSession, sf: str) -> DataFrame:
    labels = _labels(spark, sf)
    return r(A.full_consensus(labels, A.dominant_clusters(labels), _scores(spark, sf)), "mean_consensus", "mean_other", digits=6)


def fragment_energies(spark: SparkSession, sf: str) -> DataFrame:
    vina = _scores(spark, sf).select("name", "pose_index", (F.col("value") / 1000).alias("vina"))
    out = A.fragment_energies(_terms(spark, sf), _fragment_atoms(spark, sf), vina)
    return r(out, *[c for c, t in out.dtypes if t == "double"])


def ols_fits(spark: SparkSession, sf: str) -> DataFrame:
    return r(O.score_decomposition(_labels(spark, sf), _scores(spark, sf))[0], "r2", "adj_r2", "residual_std", "intercept", digits=6)


def ols_decomposition(spark: SparkSession, sf: str) -> DataFrame:
    return r(O.score_decomposition(_labels(spark, sf), _scores(spark, sf))[1], "coefficient", "std_error", "partial_r2", digits=6)


def _one_fragment(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return O.score_decomposition(_labels(spark, sf).filter("fragment_id = 0"), _scores(spark, sf))


def ols_single_fits(spark: SparkSession, sf: str) -> DataFrame:
    """Fits of the scores by the clusters of one fragment alone, where it has two clusters or more."""
    return r(_one_fragment(spark, sf)[0].filter("n_levels > 0"), "r2", "adj_r2", "residual_std", "intercept", digits=6)


def ols_single_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Coefficients of these fits."""
    fits, parts = _one_fragment(spark, sf)
    return r(parts.join(fits.filter("n_levels > 0").select("name"), "name", "left_semi"), "coefficient", "std_error", "partial_r2", digits=6)


def _weighted(spark: SparkSession, sf: str) -> DataFrame:
    df = _centroids(spark, sf, "fragment_label", "dominant_fraction", "score_contribution", "is_ring", "n_atoms").filter("molecule_name is not null and dominant_fraction is not null and score_contribution is not null and fragment_label is not null")
    return df.select(F.col("molecule_name").alias("name"), "fragment_label", "dominant_fraction", F.col("score_contribution").alias("weight"), "is_ring", "n_atoms")


def convergence(spark: SparkSession, sf: str) -> DataFrame:
    out = r(A.weighted_convergence(_weighted(spark, sf)), "weighted_convergence").withColumn("badge", stability(F.col("weighted_convergence")))
    return out.select("name", "weighted_convergence", "min_convergence", "n_fragments", "badge")


def composite_ranking(spark: SparkSession, sf: str) -> DataFrame:
    vina = T.ranking(spark, sf, "vina_affinity").groupBy("name").agg(F.min("vina_affinity").alias("vina_affinity"))
    out = A.composite_ranking(r(A.weighted_convergence(_weighted(spark, sf)), "weighted_convergence"), vina)
    return r(out, "composite_score").select("rank", "name", "vina_affinity", "weighted_convergence", "composite_score")


def hotspot_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Hotspots of the fragment centroids by density clusters, with their statistics."""
    df = _centroids(spark, sf, "dominant_fraction", "score_contribution", "is_ring").filter("campaign_id is not null")
    groups = D.dbscan_positions(df, "centroid_id", 2.0, 3, ("campaign_id",)).filter("cluster is not null").select("centroid_id", F.col("cluster").alias("hotspot"))
    out = A.hotspot_statistics(df.join(groups, "centroid_id").withColumnRenamed("molecule_name", "name"))
    return r(out, *[c for c, t in out.dtypes if t == "double"])


def hotspot_votes(spark: SparkSession, sf: str) -> DataFrame:
    """What residues the members of each hotspot touch, by distinct molecules, and the most frequent kind of contact."""
    df = _centroids(spark, sf, "fragment_id", "cluster_id").filter("campaign_id is not null and molecule_name is not null")
    groups = D.dbscan_positions(df, "centroid_id", 2.0, 3, ("campaign_id",)).filter("cluster is not null").select("centroid_id", F.col("cluster").alias("hotspot"))
    members = df.join(groups, "centroid_id").select("hotspot", "molecule_name", "fragment_id", "cluster_id")
    contacts = T.molecule_contacts(spark, sf).select("molecule_name", "fragment_id", "cluster_id", "residue", "contact_type", "min_distance")
    return r(K.contact_votes(K.member_contacts(members, contacts), ["hotspot"]), "mean_distance", "frac_molecules")


def pose_medoids(spark: SparkSession, sf: str) -> DataFrame:
    """Medoids of vectors' clusters by nearest label group, at most three a fragment."""
    poses = _conformations(spark, sf)
    labels = poses.select("name", F.lit(0).alias("fragment_id"), "pose_index", (F.col("pose_index") % 5 - 1).cast("int").alias("cluster"))
    pairs = pose_pairs(poses).withColumn("fragment_id", F.lit(0))
    return A.selected_structures(A.medoids(pairs, labels), 3)


def export_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Poses to be written out: medoids of the largest clusters, the consensus pose, the best pose of the three best label tuples."""
    poses = _conformations(spark, sf)
    labels = poses.select("name", F.lit(0).alias("fragment_id"), "pose_index", (F.col("pose_index") % 5 - 1).cast("int").alias("cluster"))
    scores = poses.select("name", "pose_index", F.lit("score").alias("score_key"), F.col("score").alias("value"))
    return S.export_selection(pose_pairs(poses).withColumn("fragment_id", F.lit(0)), labels, A.dominant_clusters(labels), scores)


def best_fragments(spark: SparkSession, sf: str) -> DataFrame:
    """Each molecule's fragment of lowest weight * convergence."""
    return A.weighted_convergence(_weighted(spark, sf)).select("name", F.regexp_replace("best_fragment", r" \([^()]*\)$", "").alias("best_fragment"))


def fragment_assessments(spark: SparkSession, sf: str) -> DataFrame:
    """Fragments by what they are good for, rings and linkers apart."""
    what = fragment_assessment(F.col("weight"), F.col("dominant_fraction"))
    return _weighted(spark, sf).groupBy("is_ring", what.alias("assessment")).agg(F.count(F.lit(1)).alias("n"))


def contact_consensus(spark: SparkSession, sf: str) -> DataFrame:
    return r(K.contact_consensus(T.molecule_contacts(spark, sf)), "mean_distance", "mean_contacts", "frac_molecules")


def contact_votes(spark: SparkSession, sf: str) -> DataFrame:
    return r(K.contact_votes(T.molecule_contacts(spark, sf).filter("fragment_label is not null"), ["fragment_label"]), "mean_distance", "frac_molecules")


def contact_heat_top(spark: SparkSession, sf: str) -> DataFrame:
    """The heat map over the 20 residues of the data that most molecules touch, one row for a residue and molecule."""
    return K.heat_rows(T.molecule_contacts(spark, sf), 20)


def nearest_residues(spark: SparkSession, sf: str) -> DataFrame:
    return K.nearest_residues(T.molecule_contacts(spark, sf), ["molecule_name", "fragment_id"], 3)


def hit_export(spark: SparkSession, sf: str) -> DataFrame:
    molecules = T.latest(spark, sf, "molecules", "smiles", "source_file", "smiles_duplicate_of")
    originals = molecules.filter("smiles_duplicate_of is null").select("name", "smiles", "source_file")
    return X.hit_export(consensus_hits(spark, sf), originals, molecules.select("name", F.col("smiles_duplicate_of").alias("duplicate_of")), exclude="REF_")


def missing_originals(spark: SparkSession, sf: str) -> DataFrame:
    """Molecules of the ranking that the molecule table lacks."""
    return X.unresolved(T.ranking(spark, sf), T.latest(spark, sf, "molecules", "smiles"))


def poses_per_source(spark: SparkSession, sf: str) -> DataFrame:
    """Scored structures by where they come from; the ranking's file wins over the molecule table's."""
    a = T.latest(spark, sf, "molecules", "source_file").filter("source_file is not null").select("name", F.col("source_file").alias("path"))
    b = T.ranking(spark, sf).groupBy("name").agg(F.min("source_file").alias("path"))
    return X.resolve_sources(a, b).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def top_fragments(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 fragments of lowest weight * convergence."""
    df = _centroids(spark, sf, "fragment_label", "dominant_fraction", "score_contribution").withColumn("product", F.col("score_contribution") * F.col("dominant_fraction"))
    return r(R.lowest(df, "product", 20, ["centroid_id"]).select("centroid_id", "molecule_name", "fragment_label", "product"), "product")


QUERIES = [
    cluster_score_stats, dominant_clusters, sweet_spots, full_consensus_poses, fragment_energies, ols_fits, ols_decomposition, ols_single_fits, ols_single_parts, convergence, composite_ranking, hotspot_stats, hotspot_votes, pose_medoids, export_selection, best_fragments, fragment_assessments,
    contact_consensus, contact_votes, contact_heat_top, nearest_residues, hit_export, missing_originals, poses_per_source, top_fragments,
]

_L = "l AS (SELECT l_suppkey AS name, l_linenumber % 4 AS fragment_id, l_orderkey % 40 AS pose_index, CAST(sum(l_partkey) % 4 - 1 AS INT) AS cluster FROM lineitem GROUP BY 1, 2, 3), s AS (SELECT l_suppkey AS name, l_orderkey % 40 AS pose_index, -min(l_extendedprice) AS value FROM lineitem GROUP BY 1, 2)"
_DOM = _L + """, z AS (SELECT name, fragment_id, cluster, count(*) AS n FROM l GROUP BY 1, 2, 3),
d AS (SELECT name, fragment_id, sum(n) AS n_poses, count(*) FILTER (cluster >= 0) AS n_clusters, coalesce(sum(n) FILTER (cluster < 0), 0) AS n_noise, coalesce(arg_min(cluster, row(-n, cluster)) FILTER (cluster >= 0), -1) AS dominant_cluster,
 coalesce(max(n) FILTER (cluster >= 0), 0) AS dominant_size, coalesce(string_agg(CASE WHEN cluster >= 0 THEN CAST(n AS VARCHAR) END, ',' ORDER BY n DESC), '') AS sizes FROM z GROUP BY 1, 2)"""
_LF = LATEST_OK("fragment_centroids", ["centroid_id"])
_FC = f"v0 AS ({_LF}), v AS (SELECT * FROM v0 WHERE len(centroid) = 3 AND isfinite(centroid[1]) AND isfinite(centroid[2]) AND isfinite(centroid[3]))"
_CONV = _FC + """, w AS (SELECT molecule_name AS name, fragment_label, dominant_fraction AS c, score_contribution AS w FROM v WHERE molecule_name IS NOT NULL AND isfinite(dominant_fraction) AND isfinite(score_contribution) AND fragment_label IS NOT NULL),
g AS (SELECT name, round(CASE WHEN sum(abs(w)) > 0 THEN sum(c * abs(w)) / sum(abs(w)) ELSE avg(c) END, @9) AS weighted_convergence, min(c) AS min_convergence, count(*) AS n_fragments FROM w GROUP BY 1)"""
_DBSCAN = f"""{_C}, n AS MATERIALIZED (SELECT a.campaign_id, a.centroid_id AS u, b.centroid_id AS v FROM c a JOIN c b ON a.campaign_id = b.campaign_id AND abs(a.x - b.x) <= 2.001 AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 4),
k AS MATERIALIZED (SELECT u FROM n GROUP BY 1 HAVING count(*) >= 3), e AS MATERIALIZED (SELECT u, v FROM n WHERE u IN (SELECT u FROM k) AND v IN (SELECT u FROM k)),
w(root, node) AS (SELECT u, u FROM k UNION SELECT w.root, e.v FROM w JOIN e ON e.u = w.node), g AS (SELECT node, min(root) AS cluster FROM w GROUP BY 1), z AS (SELECT n.u, min(g.cluster) AS cluster FROM n JOIN g ON g.node = n.v GROUP BY 1),
h AS (SELECT c.*, coalesce(g.cluster, z.cluster) AS hotspot, f.is_ring, CASE WHEN isfinite(f.dominant_fraction) THEN f.dominant_fraction END AS df, CASE WHEN isfinite(f.score_contribution) THEN nullif(f.score_contribution, 0) END AS sc FROM c JOIN l f USING (centroid_id) LEFT JOIN g ON g.node = c.centroid_id LEFT JOIN z ON z.u = c.centroid_id),
m AS (SELECT hotspot, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM h WHERE hotspot IS NOT NULL AND campaign_id IS NOT NULL GROUP BY 1)"""
_T = """t AS (SELECT l_suppkey AS name, l_orderkey % 40 AS pose_index, l_linenumber AS atom_index, -min(l_quantity) / 100 AS gauss1, -min(l_discount) AS gauss2, max(l_tax) AS repulsion, -min(l_discount) * 2 AS hydrophobic, -0.01 AS hbond FROM lineitem GROUP BY 1, 2, 3),
p AS (SELECT name, pose_index, atom_index % 3 AS fragment_id, sum(gauss1 + gauss2 + repulsion + hydrophobic + hbond) AS energy, sum(gauss1) AS gauss1, sum(gauss2) AS gauss2, sum(repulsion) AS repulsion, sum(hydrophobic) AS hydrophobic, sum(hbond) AS hbond FROM t GROUP BY 1, 2, 3),
q AS (SELECT p.*, CASE WHEN sum(abs(energy)) OVER w >= 1e-10 THEN abs(energy) / sum(abs(energy)) OVER w ELSE 0 END AS share FROM p WINDOW w AS (PARTITION BY name, pose_index)),
v AS (SELECT q.*, s.value / 1000 * share AS pr FROM q LEFT JOIN s USING (name, pose_index))"""
_ONE = f"""WITH {_L}, a AS (SELECT name, pose_index, cluster, value FROM l JOIN s USING (name, pose_index) WHERE fragment_id = 0 AND cluster >= 0),
g AS (SELECT name, cluster, count(*) AS n, avg(value) AS m, var_pop(value) * count(*) AS ss FROM a GROUP BY 1, 2),
t AS (SELECT name, var_pop(value) * count(*) AS sst FROM a GROUP BY 1), e AS (SELECT name, sum(n) AS n_poses, count(*) - 1 AS n_levels, sum(ss) AS sse, min(cluster) AS low, arg_min(m, cluster) AS intercept, arg_min(n, cluster) AS n_low FROM g GROUP BY 1),
f AS (SELECT name, 'vina_affinity' AS score_key, CAST(n_poses AS INT) AS n_poses, CAST(n_levels AS INT) AS n_levels, n_poses - n_levels - 1 AS free, sse, low, intercept, n_low, CASE WHEN sst <= 1e-12 THEN 0 ELSE 1 - sse / sst END AS r2
 FROM e JOIN t USING (name) WHERE n_poses >= 5 AND n_poses >= n_levels + 2 AND n_levels > 0 AND sst > 1e-12 AND sse < sst)"""

SQL = {
    "cluster_score_stats": f"WITH {_L} SELECT name, fragment_id, cluster, 'vina_affinity' AS score_key, round(avg(value), @6) AS mean, min(value) AS best, max(value) AS worst, round(stddev_pop(value), @6) AS std, count(*) AS n FROM l JOIN s USING (name, pose_index) WHERE cluster >= 0 GROUP BY 1, 2, 3",
    "dominant_clusters": f"WITH {_DOM} SELECT name, fragment_id, CAST(n_poses AS BIGINT) AS n_poses, n_clusters, CAST(n_noise AS BIGINT) AS n_noise, sizes, dominant_cluster, dominant_size, round(dominant_size / n_poses, @9) AS dominant_fraction, round(n_noise / n_poses, @9) AS noise_fraction, dominant_size / n_poses < 0.45 AS low_confidence FROM d",
    "sweet_spots": f"""WITH {_L}, a AS (SELECT name, pose_index, string_agg(CAST(cluster AS VARCHAR), ',' ORDER BY fragment_id) AS labels, list(cluster ORDER BY fragment_id) AS k, min(cluster) AS low FROM l GROUP BY 1, 2),
b AS (SELECT name, labels, k, count(*) AS n, avg(value) AS m, min(value) AS best, stddev_pop(value) AS sd FROM a JOIN s USING (name, pose_index) WHERE low >= 0 GROUP BY 1, 2, 3)
SELECT name, labels, n, round(m, @6) AS mean, best, round(sd, @6) AS std FROM b QUALIFY row_number() OVER (PARTITION BY name ORDER BY m, k) <= 3""",
    "full_consensus_poses": f"""WITH {_DOM}, w AS (SELECT l.name, pose_index, bool_and(cluster = dominant_cluster) AS w FROM l JOIN d USING (name, fragment_id) GROUP BY 1, 2)
SELECT name, count(*) FILTER (w) AS n_consensus, round(avg(value) FILTER (w), @6) AS mean_consensus, min(value) FILTER (w) AS best_consensus, round(avg(value) FILTER (NOT w), @6) AS mean_other FROM w JOIN s USING (name, pose_index) GROUP BY 1""",
    "fragment_energies": f"WITH {_L}, {_T} SELECT name, fragment_id, " + ", ".join(f"round({e}, @9) AS {n}" for n, e in {
        "vina_mean": "avg(energy)", "vina_std": "stddev_pop(energy)", "vina_best": "min(energy)", "vina_worst": "max(energy)", **{f"{t}_contrib": f"avg({t})" for t in A.TERMS},
        "proportional_vina_mean": "avg(pr)", "proportional_vina_std": "stddev_pop(pr)", "proportional_vina_best": "min(pr)", "proportion_of_total": "avg(share)",
    }.items()) + " FROM v GROUP BY 1, 2",
    "ols_single_fits": _ONE + " SELECT name, score_key, n_poses, n_levels, round(r2, @6) AS r2, round(CASE WHEN free > 0 THEN 1 - (1 - r2) * (n_poses - 1) / free ELSE r2 END, @6) AS adj_r2, round(sqrt(CASE WHEN free > 0 THEN sse / free ELSE 0 END), @6) AS residual_std, round(intercept, @6) AS intercept FROM f",
    "ols_single_parts": _ONE + """ SELECT f.name, score_key, 0 AS fragment_id, cluster, round(m - intercept, @6) AS coefficient,
 round(CASE WHEN cluster = low OR free <= 0 THEN 0 ELSE sqrt(sse / free * (1 / n + 1 / n_low)) END, @6) AS std_error, round(r2, @6) AS partial_r2, CAST(n AS INT) AS n_poses FROM f JOIN g USING (name)""",
    "hotspot_votes": f"""WITH hh AS (WITH RECURSIVE {_DBSCAN} SELECT h.centroid_id, h.hotspot, l.molecule_name, l.fragment_id, l.cluster_id FROM h JOIN l USING (centroid_id) WHERE h.hotspot IS NOT NULL AND h.campaign_id IS NOT NULL AND l.molecule_name IS NOT NULL), {_CONTACTS},
j AS (SELECT hotspot, m.* FROM hh JOIN m USING (molecule_name, fragment_id, cluster_id)), g AS (SELECT hotspot, count(DISTINCT molecule_name) AS n_group FROM j GROUP BY 1),
o AS (SELECT hotspot, residue, contact_type, count(*) AS n FROM j WHERE contact_type IS NOT NULL GROUP BY 1, 2, 3), y AS (SELECT hotspot, residue, arg_min(contact_type, row(-n, contact_type)) AS dominant_type FROM o GROUP BY 1, 2),
a AS (SELECT hotspot, residue, count(DISTINCT molecule_name) AS n_molecules, round(avg(min_distance), @9) AS mean_distance, min(min_distance) AS min_distance FROM j GROUP BY 1, 2)
SELECT a.*, dominant_type, round(n_molecules / n_group, @9) AS frac_molecules FROM a JOIN g USING (hotspot) LEFT JOIN y USING (hotspot, residue)""",
    "convergence": f"WITH {_CONV} SELECT *, CASE WHEN weighted_convergence >= 0.7 THEN 'STABLE' WHEN weighted_convergence >= 0.5 THEN 'MODERATE' ELSE 'UNSTABLE' END AS badge FROM g",
    "composite_ranking": f"""WITH {_CONV}, x AS ({RANKING}), a AS (SELECT name, min(vina_affinity) AS vina_affinity FROM x WHERE isfinite(vina_affinity) GROUP BY 1)
SELECT row_number() OVER (ORDER BY vina_affinity * weighted_convergence, name) AS rank, name, vina_affinity, weighted_convergence, round(vina_affinity * weighted_convergence, @9) AS composite_score FROM a JOIN g USING (name)""",
    "hotspot_stats": f"""WITH RECURSIVE {_DBSCAN}, o AS (SELECT hotspot, cx, cy, cz, max(sqrt((x - cx) ** 2 + (y - cy) ** 2 + (z - cz) ** 2)) AS radius, count(DISTINCT molecule_name) AS n_molecules, count(*) AS n_fragments, avg(is_ring::INT) AS ring_fraction,
 avg(df) AS mean_dominant_fraction, coalesce(avg(sc), 0) AS mean_score_contribution, coalesce(min(sc), 0) AS best_score_contribution FROM h JOIN m USING (hotspot) GROUP BY 1, 2, 3, 4)
SELECT hotspot, n_molecules, n_fragments, row_number() OVER (ORDER BY n_molecules DESC, hotspot) - 1 AS number, """ + ", ".join(f"round({c}, @9) AS {c}" for c in ("cx", "cy", "cz", "radius", "ring_fraction", "mean_dominant_fraction", "mean_score_contribution", "best_score_contribution")) + " FROM o",
    "pose_medoids": f"""WITH {_V}, k AS (SELECT name, pose_index, CAST(pose_index % 5 - 1 AS INT) AS cluster, e FROM v WHERE pose_index % 5 > 0),
d AS (SELECT a.name, a.cluster, a.pose_index, sum(sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda t: (t[1] - t[2]) ** 2)) / 21)) AS s FROM k a JOIN k b ON a.name = b.name AND a.cluster = b.cluster GROUP BY 1, 2, 3),
m AS (SELECT name, cluster, arg_min(pose_index, row(s, pose_index)) AS pose_index, count(*) AS size FROM d GROUP BY 1, 2)
SELECT name, 0 AS fragment_id, cluster, pose_index, size, row_number() OVER (PARTITION BY name ORDER BY size DESC, cluster) AS place FROM m QUALIFY place <= 3""",
    "export_selection": f"""WITH {_V}, k AS (SELECT name, pose_index, CAST(pose_index % 5 - 1 AS INT) AS cluster, score, e FROM v), z AS (SELECT name, cluster, count(*) AS n FROM k GROUP BY 1, 2),
b AS (SELECT name, coalesce(arg_min(cluster, row(-n, cluster)) FILTER (cluster >= 0), -1) AS dom FROM z GROUP BY 1),
d AS (SELECT a.name, a.cluster, a.pose_index, sum(sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda t: (t[1] - t[2]) ** 2)) / 21)) AS s FROM k a JOIN k b ON a.name = b.name AND a.cluster = b.cluster GROUP BY 1, 2, 3),
m AS (SELECT name, cluster, arg_min(pose_index, row(s, pose_index)) AS pose_index, count(*) AS size FROM d GROUP BY 1, 2),
p AS (SELECT name, 'frag0_cl' || cluster AS label, pose_index FROM m WHERE cluster >= 0 QUALIFY row_number() OVER (PARTITION BY name ORDER BY size DESC, cluster) <= 3),
t AS (SELECT name, cluster, row_number() OVER (PARTITION BY name ORDER BY avg(score), cluster) AS place FROM k WHERE cluster >= 0 GROUP BY 1, 2 QUALIFY place <= 3)
SELECT * FROM p UNION ALL SELECT m.name, 'full_consensus', pose_index FROM m JOIN b ON b.name = m.name AND b.dom = m.cluster
UNION ALL SELECT k.name, 'sweet' || place || '_score', arg_min(pose_index, row(score, pose_index)) FROM k JOIN t USING (name, cluster) GROUP BY k.name, place""",
    "best_fragments": f"WITH {_CONV} SELECT name, arg_min(fragment_label, row(w * c, fragment_label)) AS best_fragment FROM w GROUP BY 1",
    "fragment_assessments": f"""WITH {_FC}, w AS (SELECT is_ring, dominant_fraction AS c, score_contribution AS e FROM v WHERE molecule_name IS NOT NULL AND isfinite(dominant_fraction) AND isfinite(score_contribution) AND fragment_label IS NOT NULL)
SELECT is_ring, CASE WHEN e < -3 AND c >= 0.7 THEN 'Anchor' WHEN e < -2 AND c >= 0.7 THEN 'Reliable' WHEN e < -3 AND c < 0.5 THEN 'Potent but variable' WHEN c < 0.3 THEN 'Unreliable' WHEN c >= 0.7 THEN 'Stable, weak' ELSE 'Moderate' END AS assessment, count(*) AS n FROM w GROUP BY 1, 2""",
    "contact_consensus": f"WITH {_CONTACTS} SELECT residue, count(DISTINCT molecule_name) AS n_molecules, round(avg(min_distance), @9) AS mean_distance, round(avg(n_atom_contacts), @9) AS mean_contacts, round(count(DISTINCT molecule_name) / (SELECT count(DISTINCT molecule_name) FROM m), @9) AS frac_molecules FROM m GROUP BY 1",
    "contact_votes": f"""WITH {_CONTACTS}, g AS (SELECT fragment_label, count(DISTINCT molecule_name) AS n_group FROM m WHERE fragment_label IS NOT NULL GROUP BY 1),
o AS (SELECT fragment_label, residue, contact_type, count(*) AS n FROM m WHERE contact_type IS NOT NULL AND fragment_label IS NOT NULL GROUP BY 1, 2, 3), y AS (SELECT fragment_label, residue, arg_min(contact_type, row(-n, contact_type)) AS dominant_type FROM o GROUP BY 1, 2),
a AS (SELECT fragment_label, residue, count(DISTINCT molecule_name) AS n_molecules, round(avg(min_distance), @9) AS mean_distance, min(min_distance) AS min_distance FROM m WHERE fragment_label IS NOT NULL GROUP BY 1, 2)
SELECT a.*, dominant_type, round(n_molecules / n_group, @9) AS frac_molecules FROM a JOIN g USING (fragment_label) LEFT JOIN y USING (fragment_label, residue)""",
    "contact_heat_top": f"""WITH {_CONTACTS}, top AS (SELECT residue, row_number() OVER (ORDER BY count(DISTINCT molecule_name) DESC, residue) AS place FROM m GROUP BY 1 QUALIFY place <= 20)
SELECT place, residue, molecule_name, min(min_distance) AS min_distance FROM m JOIN top USING (residue) GROUP BY 1, 2, 3""",
    "nearest_residues": f"WITH {_CONTACTS}, a AS (SELECT molecule_name, fragment_id, residue, min(min_distance) AS min_distance FROM m GROUP BY 1, 2, 3) SELECT *, row_number() OVER (PARTITION BY molecule_name, fragment_id ORDER BY min_distance NULLS LAST, residue) AS place FROM a QUALIFY place <= 3",
    "hit_export": _MERGED + f""", o AS ({_MOL}), c AS (SELECT name FROM m WHERE n_lists >= 2 AND NOT starts_with(name, 'REF_')), k AS (SELECT name, smiles, source_file FROM o WHERE smiles_duplicate_of IS NULL), dd AS (SELECT name, smiles_duplicate_of AS dup FROM o WHERE smiles_duplicate_of IS NOT NULL),
ff AS (SELECT c.name, CASE WHEN k.name IS NOT NULL THEN c.name ELSE dd.dup END AS found_as FROM c LEFT JOIN k ON k.name = c.name LEFT JOIN dd ON dd.name = c.name)
SELECT ff.name, found_as, k.smiles, k.source_file, k.name IS NOT NULL AS exported FROM ff LEFT JOIN k ON k.name = ff.found_as""",
    "missing_originals": f"WITH x AS ({RANKING}), o AS ({_MOL}) SELECT DISTINCT name FROM x WHERE name NOT IN (SELECT name FROM o)",
    "poses_per_source": f"""WITH x AS ({RANKING}), o AS ({_MOL}), b AS (SELECT name, min(source_file) AS path FROM x GROUP BY 1),
u AS (SELECT name, path FROM b UNION ALL SELECT name, source_file FROM o WHERE source_file IS NOT NULL AND name NOT IN (SELECT name FROM b)) SELECT path, count(*) AS n FROM u GROUP BY 1""",
    "top_fragments": f"WITH {_FC}, t AS (SELECT centroid_id, molecule_name, fragment_label, score_contribution * dominant_fraction AS p FROM v WHERE isfinite(score_contribution) AND isfinite(dominant_fraction)) SELECT centroid_id, molecule_name, fragment_label, round(p, @9) AS product FROM t ORDER BY p, centroid_id LIMIT 20",
}
