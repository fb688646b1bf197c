"""Rankings, duplicates, consensus and agreement between engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import correlation_words, dominance_share
from ..operators import consensus as C
from ..operators import ranking as R
from . import tables as T
from .sql import LATEST, LATEST_OK, RANKING, r


def best_pose(spark: SparkSession, sf: str) -> DataFrame:
    return R.best_rows(T.poses(spark, sf), "name", "grid_score", ["pose_index"])


def score_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return r(R.score_ranking(T.poses(spark, sf)), "vdw_fraction", "es_fraction", "mean_score", "std_score", "score_range")


def score_ranking_top20(spark: SparkSession, sf: str) -> DataFrame:
    """The ranked best poses with the SMILES of their molecules."""
    top = R.score_ranking(T.poses(spark, sf), top_n=20).select("rank", "name", "grid_score", "dominance", "n_poses")
    return top.join(T.latest(spark, sf, "molecules", "smiles", "mw"), "name", "left")


def dominance_counts(spark: SparkSession, sf: str) -> DataFrame:
    best = R.best_rows(T.poses(spark, sf), "name", "grid_score", ["pose_index"])
    kind = dominance_share(F.col("grid_vdw_energy"), F.col("grid_es_energy"))
    return best.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def _engine(spark: SparkSession, sf: str) -> DataFrame:
    return T.ranking(spark, sf, "vina_affinity", "cnn_score", "cnn_affinity").withColumn("success", F.col("vina_affinity").isNotNull())


def engine_ranks(spark: SparkSession, sf: str) -> DataFrame:
    out = R.engine_ranks(_engine(spark, sf)).withColumn("is_reference", F.col("name").startswith("REF_"))
    return out.select("source_file", "name", "vina_rank", "cnn_score_rank", "cnn_affinity_rank", "consensus_rank", "is_top_n", "is_reference")


def pose_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return r(C.pose_statistics(T.poses(spark, sf)), "mean_grid_score", "spread", "ratio")


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    """Both engines' molecules, each ranked by its engine; a molecule of several sources counts with its best affinity."""
    gnina = T.ranking(spark, sf, "vina_affinity", "gnina_composite").groupBy("name").agg(F.min("vina_affinity").alias("vina_affinity"), F.min("gnina_composite").alias("gnina_composite")).filter("vina_affinity is not null")
    gnina = C.ranked(C.ranked(gnina, "vina_affinity", "gnina_vina_rank"), "gnina_composite", "gnina_composite_rank")
    dock6 = r(C.pose_statistics(T.poses(spark, sf)), "mean_grid_score").select("name", "best_grid_score", "mean_grid_score", "n_modes")
    dock6 = C.ranked(C.ranked(dock6, "best_grid_score", "dock6_best_rank"), "mean_grid_score", "dock6_mean_rank")
    return C.merge_engines(gnina, dock6)


def cross_engine_consensus(spark: SparkSession, sf: str) -> DataFrame:
    return r(C.consensus(_merged(spark, sf)), "avg_rank")


def consensus_hits(spark: SparkSession, sf: str) -> DataFrame:
    return C.consensus(_merged(spark, sf)).filter("n_lists >= 2").select("consensus_rank", "name", "n_lists", "best_rank")


def list_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return C.list_overlaps(C.consensus(_merged(spark, sf)))


def n_lists_counts(spark: SparkSession, sf: str) -> DataFrame:
    return C.consensus(_merged(spark, sf)).groupBy("n_lists").agg(F.count(F.lit(1)).alias("n"))


def gnina_only_hits(spark: SparkSession, sf: str) -> DataFrame:
    lists = tuple(C.LISTS)
    return C.engine_only(C.consensus(_merged(spark, sf)), lists[:2], lists[2:]).select("name", "vina_affinity")


def dock6_only_hits(spark: SparkSession, sf: str) -> DataFrame:
    lists = tuple(C.LISTS)
    return C.engine_only(C.consensus(_merged(spark, sf)), lists[2:], lists[:2]).select("name", "best_grid_score")


def engine_correlation(spark: SparkSession, sf: str) -> DataFrame:
    df = T.ranking(spark, sf, "vina_affinity", "mean_grid_score")
    return r(C.linear_fit(df, "mean_grid_score", "vina_affinity"), "pearson", "slope", "intercept").withColumn("strength", correlation_words(F.col("pearson")))


def engine_spearman(spark: SparkSession, sf: str) -> DataFrame:
    return r(C.spearman(T.ranking(spark, sf, "vina_affinity", "best_grid_score"), "vina_affinity", "best_grid_score"), "spearman")


def quadrant_counts(spark: SparkSession, sf: str) -> DataFrame:
    return r(C.quantile_counts(T.ranking(spark, sf, "vina_affinity", "weighted_convergence"), "vina_affinity", "weighted_convergence"), "q_low", "q_high", "median_other")


def smiles_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return R.mark_duplicates(T.latest(spark, sf, "molecules", "smiles", "ordinal"))


def conformer_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Of the molecules with one SMILES, the one with the lowest RMSD."""
    df = T.latest(spark, sf, "molecules", "smiles", "rmsd", "ordinal").filter("smiles is not null")
    return R.conformers(df, name="smiles").select("smiles", "name", "rmsd", "group_size")


def source_counts(spark: SparkSession, sf: str) -> DataFrame:
    return T.latest(spark, sf, "molecules", "source_file", "source_format").groupBy("source_file", "source_format").agg(F.count(F.lit(1)).alias("n"))


def top30_vina(spark: SparkSession, sf: str) -> DataFrame:
    df = T.ranking(spark, sf, "vina_affinity")
    return R.lowest(df, "vina_affinity", 30, ["name", "source_file"])


def poses_sorted_top3(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_per_group(T.poses(spark, sf).select("name", "pose_index", "grid_score"), ["name"], [F.col("grid_score").desc(), F.col("pose_index").asc()], 3)


_POSES = f"p AS ({LATEST_OK('dock6_all_poses', ['name', 'pose_index'], 'name, pose_index, grid_score, grid_vdw_energy, grid_es_energy')}), ok AS (SELECT name, pose_index, grid_score, CASE WHEN isfinite(grid_vdw_energy) THEN grid_vdw_energy END AS grid_vdw_energy, CASE WHEN isfinite(grid_es_energy) THEN grid_es_energy END AS grid_es_energy FROM p WHERE isfinite(grid_score))"
_BEST = _POSES + ", best AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY name ORDER BY grid_score, pose_index) = 1)"
_STATS = _BEST + """, stats AS (SELECT name, count(*) AS n_poses, avg(grid_score) AS mean_score, stddev_pop(grid_score) AS std_score, max(grid_score) AS worst_score FROM ok GROUP BY 1),
s AS (SELECT row_number() OVER (ORDER BY grid_score, name) AS rank, name, grid_score, grid_vdw_energy, grid_es_energy,
 round(CASE WHEN grid_score = 0 AND grid_vdw_energy IS NOT NULL THEN 0 ELSE grid_vdw_energy / grid_score END, @9) AS vdw_fraction,
 round(CASE WHEN grid_score = 0 AND grid_es_energy IS NOT NULL THEN 0 ELSE grid_es_energy / grid_score END, @9) AS es_fraction,
 CASE WHEN grid_vdw_energy IS NULL OR grid_es_energy IS NULL THEN 'unknown' WHEN abs(grid_vdw_energy) > 2 * abs(grid_es_energy) THEN 'vdW_dominant'
      WHEN abs(grid_es_energy) > 2 * abs(grid_vdw_energy) THEN 'ES_dominant' ELSE 'balanced' END AS dominance,
 n_poses, round(mean_score, @9) AS mean_score, round(std_score, @9) AS std_score, worst_score, round(worst_score - grid_score, @9) AS score_range
 FROM best JOIN stats USING (name))"""
_X = RANKING
_FIN = "CASE WHEN isfinite({0}) THEN {0} END AS {0}"
_MERGED = f"""WITH {_POSES}, x AS ({_X}),
g0 AS (SELECT name, min(CASE WHEN isfinite(vina_affinity) THEN vina_affinity END) AS vina_affinity, min(CASE WHEN isfinite(gnina_composite) THEN gnina_composite END) AS gnina_composite FROM x GROUP BY 1),
g AS (SELECT *, row_number() OVER (ORDER BY vina_affinity NULLS LAST, name) AS gnina_vina_rank, row_number() OVER (ORDER BY gnina_composite NULLS LAST, name) AS gnina_composite_rank FROM g0 WHERE vina_affinity IS NOT NULL),
d0 AS (SELECT name, min(grid_score) AS best_grid_score, round(avg(grid_score), @9) AS mean_grid_score, count(*) AS n_modes FROM ok GROUP BY 1),
d AS (SELECT *, row_number() OVER (ORDER BY best_grid_score, name) AS dock6_best_rank, row_number() OVER (ORDER BY mean_grid_score, name) AS dock6_mean_rank FROM d0),
f AS (SELECT *, coalesce(gnina_vina_rank <= 20, false) AS in_gnina_vina, coalesce(gnina_composite_rank <= 20, false) AS in_gnina_composite, coalesce(dock6_best_rank <= 20, false) AS in_dock6_best, coalesce(dock6_mean_rank <= 20, false) AS in_dock6_mean FROM g FULL JOIN d USING (name)),
h AS (SELECT *, in_gnina_vina::INT + in_gnina_composite::INT + in_dock6_best::INT + in_dock6_mean::INT AS n_lists,
 list_avg([gnina_vina_rank, gnina_composite_rank, dock6_best_rank, dock6_mean_rank]) AS avg_rank, least(gnina_vina_rank, gnina_composite_rank, dock6_best_rank, dock6_mean_rank) AS best_rank FROM f),
m AS (SELECT * REPLACE (round(avg_rank, @9) AS avg_rank), row_number() OVER (ORDER BY n_lists DESC, avg_rank NULLS LAST, name) AS consensus_rank FROM h) """
_RANKS = f"""WITH x AS ({_X}), v AS (SELECT source_file, name, {_FIN.format('vina_affinity')}, {_FIN.format('cnn_score')}, {_FIN.format('cnn_affinity')} FROM x),
k AS (SELECT *, CASE WHEN vina_affinity IS NOT NULL THEN rank() OVER (ORDER BY vina_affinity NULLS LAST) END AS vina_rank,
 CASE WHEN vina_affinity IS NOT NULL AND cnn_score IS NOT NULL THEN rank() OVER (ORDER BY CASE WHEN vina_affinity IS NOT NULL THEN cnn_score END DESC NULLS LAST) END AS cnn_score_rank,
 CASE WHEN vina_affinity IS NOT NULL AND cnn_affinity IS NOT NULL THEN rank() OVER (ORDER BY CASE WHEN vina_affinity IS NOT NULL THEN cnn_affinity END NULLS LAST) END AS cnn_affinity_rank FROM v),
a AS (SELECT *, list_avg([vina_rank, cnn_score_rank, cnn_affinity_rank]) AS mean_rank FROM k)
SELECT source_file, name, vina_rank, cnn_score_rank, cnn_affinity_rank, CASE WHEN mean_rank IS NOT NULL THEN rank() OVER (ORDER BY mean_rank NULLS LAST) END AS consensus_rank,
 coalesce(vina_rank <= 10, false) AS is_top_n, starts_with(name, 'REF_') AS is_reference FROM a"""
_MOL = LATEST("molecules", ["name"]) + " AND name IS NOT NULL"

QUERIES = [
    best_pose, score_ranking, score_ranking_top20, dominance_counts, engine_ranks, pose_statistics, cross_engine_consensus, consensus_hits, list_overlap, n_lists_counts,
    gnina_only_hits, dock6_only_hits, engine_correlation, engine_spearman, quadrant_counts, smiles_duplicates, conformer_resolution, source_counts, top30_vina, poses_sorted_top3,
]
SQL = {
    "best_pose": f"WITH {_BEST} SELECT * FROM best",
    "score_ranking": f"WITH {_STATS} SELECT * FROM s",
    "score_ranking_top20": f"WITH {_STATS}, m AS ({_MOL}) SELECT rank, name, grid_score, dominance, n_poses, smiles, CASE WHEN isfinite(mw) THEN mw END AS mw FROM s LEFT JOIN m USING (name) WHERE rank <= 20",
    "dominance_counts": f"""WITH {_BEST}, t AS (SELECT abs(grid_vdw_energy) AS v, abs(grid_es_energy) AS e FROM best)
SELECT CASE WHEN v + e = 0 THEN 'balanced' WHEN v / (v + e) > 0.65 THEN 'vdW' WHEN e / (v + e) > 0.65 THEN 'ES' WHEN v + e IS NOT NULL THEN 'balanced' END AS kind, count(*) AS n FROM t GROUP BY 1""",
    "engine_ranks": _RANKS,
    "pose_statistics": f"""WITH {_POSES} SELECT name, count(*) AS n_modes, round(avg(grid_score), @9) AS mean_grid_score, min(grid_score) AS best_grid_score, max(grid_score) AS worst_grid_score,
 round(max(grid_score) - min(grid_score), @9) AS spread, round(CASE WHEN min(grid_score) = 0 THEN 0 ELSE avg(grid_score) / min(grid_score) END, @9) AS ratio FROM ok GROUP BY 1""",
    "cross_engine_consensus": _MERGED + "SELECT * FROM m",
    "consensus_hits": _MERGED + "SELECT consensus_rank, name, n_lists, best_rank FROM m WHERE n_lists >= 2",
    "list_overlap": _MERGED + " UNION ALL ".join(f"SELECT '{a}' AS list_a, '{b}' AS list_b, count(*) FILTER ({a} AND {b}) AS n FROM m" for i, a in enumerate(C.LISTS) for b in list(C.LISTS)[i + 1 :]),
    "n_lists_counts": _MERGED + "SELECT n_lists, count(*) AS n FROM m GROUP BY 1",
    "gnina_only_hits": _MERGED + "SELECT name, vina_affinity FROM m WHERE (in_gnina_vina OR in_gnina_composite) AND NOT (in_dock6_best OR in_dock6_mean)",
    "dock6_only_hits": _MERGED + "SELECT name, best_grid_score FROM m WHERE (in_dock6_best OR in_dock6_mean) AND NOT (in_gnina_vina OR in_gnina_composite)",
    "engine_correlation": f"""WITH x AS ({_X}), t AS (SELECT vina_affinity AS y, mean_grid_score AS x FROM x WHERE isfinite(vina_affinity) AND isfinite(mean_grid_score)),
f AS (SELECT count(*) AS n, round(corr(y, x), @9) AS pearson, round(regr_slope(y, x), @9) AS slope, round(regr_intercept(y, x), @9) AS intercept FROM t)
SELECT n, CASE WHEN n >= 5 THEN pearson END AS pearson, CASE WHEN n >= 5 THEN slope END AS slope, CASE WHEN n >= 5 THEN intercept END AS intercept,
 CASE WHEN n < 5 THEN NULL WHEN abs(pearson) >= 0.7 THEN 'strong' WHEN abs(pearson) >= 0.4 THEN 'moderate' WHEN pearson IS NOT NULL THEN 'weak' END AS strength FROM f""",
    "engine_spearman": f"""WITH x AS ({_X}), t AS (SELECT vina_affinity AS y, best_grid_score AS x FROM x WHERE isfinite(vina_affinity) AND isfinite(best_grid_score)),
k AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS a, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS b FROM t)
SELECT count(*) AS n, round(CASE WHEN count(*) >= 6 THEN coalesce(corr(a, b), 0) ELSE 0 END, @9) AS spearman FROM k""",
    "quadrant_counts": f"""WITH x AS ({_X}), t AS (SELECT CASE WHEN isfinite(vina_affinity) THEN vina_affinity END AS s, CASE WHEN isfinite(weighted_convergence) THEN weighted_convergence END AS o FROM x),
q AS (SELECT quantile_cont(s, 0.3) AS q_low, quantile_cont(s, 0.7) AS q_high, median(o) AS median_other FROM t)
SELECT count(*) FILTER (s < q_low AND o > 0.5) AS strong, count(*) FILTER (s < q_low AND o <= 0.5) AS risky, count(*) FILTER (s > q_high) AS weak,
 round(any_value(q_low), @9) AS q_low, round(any_value(q_high), @9) AS q_high, round(any_value(median_other), @9) AS median_other FROM t, q""",
    "smiles_duplicates": f"""WITH m AS ({_MOL}), f AS (SELECT *, first_value(name) OVER w AS f, first_value(ordinal) OVER w AS o FROM m WINDOW w AS (PARTITION BY smiles ORDER BY ordinal, name))
SELECT name, smiles, ordinal, CASE WHEN smiles IS NOT NULL AND (ordinal, name) > (o, f) THEN f END AS duplicate_of FROM f""",
    "conformer_resolution": f"""WITH m AS ({_MOL}) SELECT smiles, name, CASE WHEN isfinite(rmsd) THEN rmsd END AS rmsd, count(*) OVER (PARTITION BY smiles) AS group_size FROM m WHERE smiles IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY smiles ORDER BY CASE WHEN isfinite(rmsd) THEN rmsd END NULLS LAST, ordinal) = 1""",
    "source_counts": f"WITH m AS ({_MOL}) SELECT source_file, source_format, count(*) AS n FROM m GROUP BY 1, 2",
    "top30_vina": f"WITH x AS ({_X}) SELECT source_file, name, vina_affinity FROM x WHERE isfinite(vina_affinity) ORDER BY vina_affinity, name, source_file LIMIT 30",
    "poses_sorted_top3": f"WITH {_POSES} SELECT name, pose_index, grid_score, row_number() OVER (PARTITION BY name ORDER BY grid_score DESC, pose_index) AS place FROM ok QUALIFY place <= 3",
}
