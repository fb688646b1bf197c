"""Per-residue energies, contacts against energies, zones and numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import energy_bin, residue_badge, share_bin
from ..operators import contacts as K
from ..operators import footprint as P
from . import tables as T
from .sql import LATEST_OK, r

_ENERGIES = ("mean_total", "std_total", "mean_vdw", "mean_es")


def footprint_summary(spark: SparkSession, sf: str) -> DataFrame:
    return r(P.pose_summary(T.footprint(spark, sf)), "total_vdw", "total_es", "total_energy")


def footprint_best_pose(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each molecule's best pose, by a score on the pose."""
    df = T.footprint(spark, sf)
    scored = df.join(df.groupBy("name", "pose_id").agg(F.min("total").alias("fps_score")), ["name", "pose_id"])
    return P.best_pose_only(scored).groupBy("name", "pose_id").agg(F.count(F.lit(1)).alias("n"), F.min("fps_score").alias("fps_score"))


def residue_consistency(spark: SparkSession, sf: str) -> DataFrame:
    return r(P.consistency(T.footprint(spark, sf)), *_ENERGIES, "consistency")


def weighted_consistency(spark: SparkSession, sf: str) -> DataFrame:
    return r(P.weighted_consistency(r(P.consistency(T.footprint(spark, sf)), "mean_total")), "weighted_consistency")


def residue_consensus(spark: SparkSession, sf: str) -> DataFrame:
    return r(P.residue_consensus(T.footprint(spark, sf)), *_ENERGIES, "frac_present", "frac_contributing")


def pharmacophore_residues(spark: SparkSession, sf: str) -> DataFrame:
    return P.pharmacophore(P.residue_consensus(T.footprint(spark, sf), cutoff=-1.0), least=0.8).select("residue_id", "n_contributing", "min_total")


def reference_deltas(spark: SparkSession, sf: str) -> DataFrame:
    df = P.reference_deltas(T.footprint(spark, sf), least=2.5)
    return df.groupBy("residue_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("delta_total"), 6).alias("min_delta"), F.round(F.max("delta_total"), 6).alias("max_delta"))


def residue_importance(spark: SparkSession, sf: str) -> DataFrame:
    out = K.residue_importance(P.residue_consensus(T.footprint(spark, sf)), 20)
    return r(out.select("residue_id", "n_molecules", "importance"), "importance")


def consensus_top25(spark: SparkSession, sf: str) -> DataFrame:
    """The 25 residues of lowest mean energy, binned by energy and by the share of molecules that gain by them."""
    out = r(P.residue_consensus(T.footprint(spark, sf)), "mean_total", "frac_contributing").orderBy("mean_total", "residue_id").limit(25)
    return out.select("residue_id", "mean_total", "frac_contributing", energy_bin(F.col("mean_total")).alias("energy_bin"), share_bin(F.col("frac_contributing")).alias("share_bin"))


def reference_top30(spark: SparkSession, sf: str) -> DataFrame:
    """The 30 residues of lowest energy in the poses, beside the reference's."""
    out = r(P.residue_consensus(T.footprint(spark, sf)), "mean_total").withColumn("ref_total", F.col("ref_vdw") + F.col("ref_es"))
    return out.orderBy("mean_total", "residue_id").limit(30).select("residue_id", "mean_total", "ref_total")


def residue_badges(spark: SparkSession, sf: str) -> DataFrame:
    """Residues of molecules by what they mean for them."""
    badge = residue_badge(F.col("mean_total"), F.col("consistency"))
    return r(P.consistency(T.footprint(spark, sf)), "mean_total", "consistency").groupBy(badge.alias("badge")).agg(F.count(F.lit(1)).alias("n"))


def contact_vs_footprint(spark: SparkSession, sf: str) -> DataFrame:
    lines, parts = T.raw(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_quantity"), T.raw(spark, sf, "part", "p_partkey", "p_brand")
    near = lines.filter("l_quantity <= 3").join(parts, lines.l_partkey == parts.p_partkey).groupBy(F.col("l_suppkey").alias("name"), F.col("p_brand").alias("residue_id")).agg((F.min("l_quantity") + 2.0).alias("min_distance"))
    one = T.footprint(spark, sf).groupBy("name", "residue_id", "pose_id").agg(F.min("vdw").alias("vdw"), F.min("es").alias("es"), F.min("total").alias("total"))
    return K.contacts_and_energies(near, one)


def zone_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """Molecules and contacts by zone of the receptor; residues unknown to it are in zone ``other``."""
    zones = T.raw(spark, sf, "receptor_residues", "residue_id", "zone_label", "druglike")
    df = T.molecule_contacts(spark, sf).join(zones, F.col("residue") == zones.residue_id, "left").withColumn("zone", F.coalesce("zone_label", F.lit("other")))
    return df.groupBy("zone").agg(F.countDistinct("residue").alias("n_residues"), F.countDistinct("molecule_name").alias("n_molecules"), F.count(F.lit(1)).alias("n_contacts"), F.count_if("druglike").alias("n_druglike"))


def zone_energies(spark: SparkSession, sf: str) -> DataFrame:
    """Mean distances of the consensus contacts summed by zone, the closest residues listed."""
    zones = T.raw(spark, sf, "receptor_residues", "residue_id", "zone_label")
    c = r(K.contact_consensus(T.molecule_contacts(spark, sf)), "mean_distance").withColumnRenamed("residue", "residue_id")
    c = c.withColumns({"mean_total": -F.col("mean_distance"), "mean_vdw": F.col("n_molecules").cast("double"), "mean_es": F.lit(0.0)})
    return r(P.zone_energies(c, zones), "sum_total").withColumn("strongest", F.concat_ws(",", "strongest"))


def residue_mapping(spark: SparkSession, sf: str) -> DataFrame:
    rec = T.raw(spark, sf, "receptor_residues")
    subs = rec.select(F.col("ordinal").alias("seq_id"), F.concat("residue_name", F.col("residue_number").cast("string")).alias("resname"))
    return P.numbering_map(subs, rec.select("ordinal", F.col("residue_name").alias("resname"), F.col("residue_number").alias("resid"), "chain"))


QUERIES = [footprint_summary, footprint_best_pose, residue_consistency, weighted_consistency, residue_consensus, pharmacophore_residues, reference_deltas, residue_importance, consensus_top25, reference_top30, residue_badges, contact_vs_footprint, zone_contacts, zone_energies, residue_mapping]

_F = """f AS (SELECT l_suppkey AS name, CAST(l_orderkey % 16 AS INT) AS pose_id, p_brand AS residue_id, (round(l_discount * 20 - 1.5, 4) + 0.0) AS vdw, (round(l_tax * 30 - l_quantity / 20, 4) + 0.0) AS es,
 round((round(l_discount * 20 - 1.5, 4) + 0.0) + (round(l_tax * 30 - l_quantity / 20, 4) + 0.0), 4) + 0.0 AS total, p_size / -50.0 AS ref_vdw, CAST(-0.25 AS DOUBLE) AS ref_es, p_size / -50.0 - 0.25 AS ref_total FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_CONSISTENT = _F + """, n AS (SELECT name, count(DISTINCT pose_id) AS n_poses FROM f GROUP BY 1 HAVING count(DISTINCT pose_id) >= 2),
c AS (SELECT name, residue_id, avg(total) AS mean_total, stddev_pop(total) AS std_total, min(total) AS min_total, max(total) AS max_total, avg(vdw) AS mean_vdw, avg(es) AS mean_es,
 count(*) FILTER (total < 0) AS n_favorable, any_value(n_poses) AS n_poses, count(*) FILTER (total < 0) / any_value(n_poses) AS consistency FROM f JOIN n USING (name) GROUP BY 1, 2)"""
_CONSENSUS = _F + """, a AS (SELECT count(DISTINCT name) AS n_all FROM f),
c AS (SELECT residue_id, count(DISTINCT name) AS n_molecules, count(DISTINCT CASE WHEN total < {cutoff} THEN name END) AS n_contributing, avg(vdw) AS mean_vdw, avg(es) AS mean_es, avg(total) AS mean_total,
 coalesce(stddev_samp(total), 0) AS std_total, min(total) AS min_total, max(total) AS max_total, arg_min(ref_vdw, row(name, pose_id, total, ref_vdw)) AS ref_vdw, min(ref_es) AS ref_es FROM f GROUP BY 1)"""
_CONTACTS = f"""k AS ({LATEST_OK("residue_contacts", ["contact_id"])}), q AS ({LATEST_OK("fragment_contact_results", ["result_id"])}),
c AS (SELECT *, trim(regexp_replace(upper(residue_id), '[\\s :/_.\\-,;|]+', ' ', 'g')) AS flat, nullif(regexp_replace(regexp_replace(lower(contact_type), '[^\\p{{L}}\\p{{N}}]+', '_', 'g'), '^_+|_+$', '', 'g'), '') AS kind FROM k),
t AS (SELECT CASE WHEN flat = '' THEN NULL WHEN regexp_matches(flat, '^[A-Z]+ ?0*[0-9]+ ?[A-Z]$') THEN regexp_replace(flat, '^([A-Z]+) ?0*([0-9]+) ?([A-Z])$', '\\1\\2.\\3')
 WHEN regexp_matches(flat, '^[A-Z] [A-Z]+ ?0*[0-9]+$') THEN regexp_replace(flat, '^([A-Z]) ([A-Z]+) ?0*([0-9]+)$', '\\2\\3.\\1') ELSE replace(flat, ' ', '.') END AS residue,
 CASE WHEN isfinite(min_distance) THEN min_distance END AS min_distance, n_atom_contacts, kind AS contact_type, q.molecule_name, q.fragment_id, q.fragment_label, q.cluster_id FROM c JOIN q USING (result_id) WHERE molecule_name IS NOT NULL),
m AS (SELECT * FROM t WHERE residue IS NOT NULL)"""

SQL = {
    "footprint_summary": f"WITH {_F} SELECT name, pose_id, round(sum(vdw), @9) AS total_vdw, round(sum(es), @9) AS total_es, round(sum(total), @9) AS total_energy, count(*) AS n_residues_total, count(*) FILTER (total < -0.5) AS n_residues_contributing FROM f GROUP BY 1, 2",
    "footprint_best_pose": f"WITH {_F}, s AS (SELECT name, pose_id, min(total) AS fps_score, count(*) AS n FROM f GROUP BY 1, 2) SELECT name, pose_id, n, fps_score FROM s QUALIFY row_number() OVER (PARTITION BY name ORDER BY fps_score, pose_id) = 1",
    "residue_consistency": f"WITH {_CONSISTENT} SELECT name, residue_id, n_favorable, n_poses, min_total, max_total, round(mean_total, @9) AS mean_total, round(std_total, @9) AS std_total, round(mean_vdw, @9) AS mean_vdw, round(mean_es, @9) AS mean_es, round(consistency, @9) AS consistency FROM c",
    "weighted_consistency": f"WITH {_CONSISTENT}, w AS (SELECT name, round(mean_total, @9) AS m, consistency AS k, abs(round(mean_total, @9)) > 0.5 AND round(mean_total, @9) < 0 AS s FROM c) SELECT name, round(coalesce(sum(abs(m) * k) FILTER (s) / sum(abs(m)) FILTER (s), 0), @9) AS weighted_consistency, count(*) FILTER (s) AS n_significant, count(*) FILTER (s AND k > 0.5) AS n_consistent FROM w GROUP BY 1",
    "residue_consensus": f"WITH {_CONSENSUS.format(cutoff=-0.5)} SELECT residue_id, n_molecules, n_contributing, min_total, max_total, ref_vdw, ref_es, round(mean_vdw, @9) AS mean_vdw, round(mean_es, @9) AS mean_es, round(mean_total, @9) AS mean_total, round(std_total, @9) AS std_total, round(n_molecules / n_all, @9) AS frac_present, round(n_contributing / n_all, @9) AS frac_contributing FROM c, a",
    "pharmacophore_residues": f"WITH {_CONSENSUS.format(cutoff=-1.0)} SELECT residue_id, n_contributing, min_total FROM c, a WHERE n_contributing / n_all >= 0.8",
    "reference_deltas": f"WITH {_F} SELECT residue_id, count(*) AS n, round(min(total - ref_total), 6) AS min_delta, round(max(total - ref_total), 6) AS max_delta FROM f WHERE abs(total - ref_total) > 2.5 GROUP BY 1",
    "residue_importance": f"WITH {_CONSENSUS.format(cutoff=-0.5)} SELECT residue_id, n_molecules, round(n_molecules * abs(mean_total), @9) AS importance FROM c ORDER BY n_molecules * abs(mean_total) DESC, residue_id LIMIT 20",
    "consensus_top25": f"""WITH {_CONSENSUS.format(cutoff=-0.5)}, t AS (SELECT residue_id, round(mean_total, @9) AS mean_total, round(n_contributing / n_all, @9) AS frac_contributing FROM c, a ORDER BY mean_total, residue_id LIMIT 25)
SELECT *, CASE WHEN mean_total < -1.0 THEN 'strong' WHEN mean_total < -0.5 THEN 'moderate' ELSE 'weak' END AS energy_bin, CASE WHEN frac_contributing >= 0.8 THEN 'high' WHEN frac_contributing >= 0.5 THEN 'medium' ELSE 'low' END AS share_bin FROM t""",
    "reference_top30": f"WITH {_CONSENSUS.format(cutoff=-0.5)}, t AS (SELECT residue_id, round(c.mean_total, @9) AS mean_total, ref_vdw + ref_es AS ref_total FROM c) SELECT * FROM t ORDER BY mean_total, residue_id LIMIT 30",
    "residue_badges": f"""WITH {_CONSISTENT}, t AS (SELECT round(mean_total, @9) AS m, round(consistency, @9) AS k FROM c)
SELECT CASE WHEN m < -5 AND k > 0.8 THEN 'Anchor' WHEN m < -2 AND k > 0.7 THEN 'Reliable' WHEN m < -5 AND k < 0.5 THEN 'Strong but variable' WHEN k < 0.3 THEN 'Unreliable' END AS badge, count(*) AS n FROM t GROUP BY 1""",
    "contact_vs_footprint": f"""WITH {_F}, k AS (SELECT l_suppkey AS name, p_brand AS residue_id, min(l_quantity) + 2.0 AS min_distance FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity <= 3 GROUP BY 1, 2),
e AS (SELECT name, residue_id, pose_id, min(vdw) AS vdw, min(es) AS es, min(total) AS total FROM f GROUP BY 1, 2, 3), o AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY name, residue_id ORDER BY pose_id) = 1),
u AS (SELECT k.name, k.residue_id, o.pose_id, min_distance, vdw, es, total FROM k LEFT JOIN o USING (name, residue_id)
 UNION ALL SELECT name, residue_id, pose_id, NULL, vdw, es, total FROM e WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.name = e.name AND k.residue_id = e.residue_id) AND total < -0.5)
SELECT *, CASE WHEN min_distance <= 4.5 AND total IS NULL THEN 'contact_only' WHEN min_distance <= 4.5 AND total < -0.5 THEN 'contact_and_energy' WHEN min_distance <= 4.5 THEN 'contact_no_energy' WHEN total < -0.5 THEN 'long_range_ES' ELSE 'weak' END AS category FROM u""",
    "zone_contacts": f"WITH {_CONTACTS} SELECT coalesce(zone_label, 'other') AS zone, count(DISTINCT residue) AS n_residues, count(DISTINCT molecule_name) AS n_molecules, count(*) AS n_contacts, count(*) FILTER (druglike) AS n_druglike FROM m LEFT JOIN receptor_residues x ON m.residue = x.residue_id GROUP BY 1",
    "zone_energies": f"""WITH {_CONTACTS}, g AS (SELECT residue, count(DISTINCT molecule_name) AS n, round(avg(min_distance), @9) AS d FROM m GROUP BY 1),
z AS (SELECT coalesce(zone_label, 'other') AS zone_label, residue, n, d, row_number() OVER (PARTITION BY coalesce(zone_label, 'other') ORDER BY -d NULLS FIRST, residue) AS k FROM g LEFT JOIN receptor_residues x ON residue = x.residue_id)
SELECT zone_label, count(*) AS n_residues, round(sum(-d), @9) AS sum_total, CAST(sum(n) AS DOUBLE) AS sum_vdw, CAST(0 AS DOUBLE) AS sum_es, string_agg(CASE WHEN k <= 5 THEN residue END, ',' ORDER BY k) AS strongest FROM z GROUP BY 1""",
    "residue_mapping": "SELECT ordinal AS seq_id, residue_name || residue_number || '.' || chain AS residue_id FROM receptor_residues",
}
