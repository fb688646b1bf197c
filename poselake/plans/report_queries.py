"""The small tables behind reports: cards, distributions, fits and top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import consensus as C
from ..operators import ranking as R
from . import tables as T
from .fragment_queries import _CONV, _FC, _weighted
from .geometry_queries import _centroids
from .rank_queries import _BEST, _MERGED, _MOL, _POSES, _X, _merged
from .sql import r


def mode_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Molecules by their number of poses."""
    return C.pose_statistics(T.poses(spark, sf)).groupBy("n_modes").agg(F.count(F.lit(1)).alias("n"))


def score_cards(spark: SparkSession, sf: str) -> DataFrame:
    """One row: number of molecules, best, worst, mean and median of their best scores."""
    best = R.best_rows(T.poses(spark, sf), "name", "grid_score", ["pose_index"])
    return r(best.agg(F.count(F.lit(1)).alias("n"), F.min("grid_score").alias("best"), F.max("grid_score").alias("worst"), F.avg("grid_score").alias("mean"), F.median("grid_score").alias("median")), "mean", "median")


def energy_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles of the energy terms: the box plot's numbers."""
    terms = ("grid_score", "grid_vdw_energy", "grid_es_energy")
    long = T.poses(spark, sf).select(F.inline(F.array(*[F.struct(F.lit(t).alias("term"), F.col(t).alias("v")) for t in terms]))).filter("v is not null")
    q = long.groupBy("term").agg(F.percentile("v", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)])).alias("q"))
    return r(q.select("term", *[F.get("q", i).alias(n) for i, n in enumerate(("low", "q1", "median", "q3", "high"))]), "low", "q1", "median", "q3", "high")


def vdw_and_es(spark: SparkSession, sf: str) -> DataFrame:
    """Both terms of the 30 molecules of lowest score."""
    best = R.best_rows(T.poses(spark, sf), "name", "grid_score", ["pose_index"])
    return R.lowest(best, "grid_score", 30, ["name"]).select("name", "grid_score", "grid_vdw_energy", "grid_es_energy")


def size_and_contribution(spark: SparkSession, sf: str) -> DataFrame:
    """Fragments' contribution over their size, rings and others: correlation and line."""
    df = _weighted(spark, sf).withColumn("n_atoms", F.col("n_atoms").cast("double")).filter("n_atoms is not null and is_ring is not null")
    out = df.groupBy("is_ring").agg(F.count(F.lit(1)).alias("n"), F.corr("n_atoms", "weight").alias("pearson"), F.regr_slope("weight", "n_atoms").alias("slope"), F.regr_intercept("weight", "n_atoms").alias("intercept"))
    return r(out, "pearson", "slope", "intercept")


def convergence_and_energy(spark: SparkSession, sf: str) -> DataFrame:
    """Mean convergence and summed contribution of every molecule with both."""
    out = _weighted(spark, sf).groupBy("name").agg(F.avg("dominant_fraction").alias("mean_convergence"), F.sum("weight").alias("sum_weight"))
    return r(out, "mean_convergence", "sum_weight")


def ring_and_linker(spark: SparkSession, sf: str) -> DataFrame:
    """Mean contribution and convergence of rings and other fragments."""
    out = _centroids(spark, sf, "is_ring", "score_contribution", "dominant_fraction").groupBy("is_ring").agg(F.count(F.lit(1)).alias("n"), F.avg("score_contribution").alias("mean_contribution"), F.avg("dominant_fraction").alias("mean_convergence"))
    return r(out, "mean_contribution", "mean_convergence")


def fragment_stack(spark: SparkSession, sf: str) -> DataFrame:
    """Contributions of the first five fragments of the 15 molecules with the lowest sum: one row per molecule."""
    df = _centroids(spark, sf, "score_contribution").filter("molecule_name is not null and score_contribution is not null")
    sums = df.groupBy("molecule_name").agg(F.round(F.sum("score_contribution"), 6).alias("total"))
    top = R.lowest(sums, "total", 15, ["molecule_name"])
    placed = R.top_per_group(df.join(top, "molecule_name"), ["molecule_name"], [F.col("centroid_id").asc()], 5)
    return placed.groupBy("molecule_name", "total").pivot("place", [1, 2, 3, 4, 5]).agg(F.min("score_contribution")).withColumnsRenamed({str(i): f"f{i}" for i in range(1, 6)})


def top20_druglikeness(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 molecules of lowest affinity with their properties."""
    vina = T.ranking(spark, sf, "vina_affinity").groupBy("name").agg(F.min("vina_affinity").alias("vina_affinity"))
    return R.lowest(vina, "vina_affinity", 20, ["name"]).join(T.latest(spark, sf, "molecules", "mw", "logp", "qed", "tpsa"), "name", "left")


def druglikeness_cards(spark: SparkSession, sf: str) -> DataFrame:
    """Share of molecules within the usual limits of size, lipophilicity and hydrogen bonds."""
    df = T.latest(spark, sf, "molecules", "mw", "logp", "hbd", "hba")
    bad = sum(((F.coalesce(c, F.lit(False))).cast("int") for c in (F.col("logp") > 5, F.col("hbd") > 5, F.col("hba") > 10)), F.coalesce(F.col("mw") > 500, F.lit(False)).cast("int"))
    return df.groupBy(bad.alias("violations")).agg(F.count(F.lit(1)).alias("n"))


def engine_best_20(spark: SparkSession, sf: str) -> DataFrame:
    """Consensus of at least two lists, the best 20."""
    return C.consensus(_merged(spark, sf)).filter("n_lists >= 2").orderBy("consensus_rank").limit(20).select("consensus_rank", "name", "n_lists", "vina_affinity", "best_grid_score")


QUERIES = [mode_histogram, score_cards, energy_terms, vdw_and_es, size_and_contribution, convergence_and_energy, ring_and_linker, fragment_stack, top20_druglikeness, druglikeness_cards, engine_best_20]

_SC = _FC + ", s AS (SELECT centroid_id, molecule_name, score_contribution AS c FROM v WHERE molecule_name IS NOT NULL AND isfinite(score_contribution)), t AS (SELECT molecule_name, round(sum(c), 6) AS total FROM s GROUP BY 1 ORDER BY 2, 1 LIMIT 15)"
SQL = {
    "mode_histogram": f"WITH {_POSES}, m AS (SELECT count(*) AS n_modes FROM ok GROUP BY name) SELECT n_modes, count(*) AS n FROM m GROUP BY 1",
    "score_cards": f"WITH {_BEST} SELECT count(*) AS n, min(grid_score) AS best, max(grid_score) AS worst, round(avg(grid_score), @9) AS mean, round(median(grid_score), @9) AS median FROM best",
    "energy_terms": f"WITH {_POSES}" + ", u AS (" + " UNION ALL ".join(f"SELECT '{t}' AS term, {t} AS v FROM ok" for t in ("grid_score", "grid_vdw_energy", "grid_es_energy")) + ") SELECT term, " + ", ".join(f"round(quantile_cont(v, {q}), @9) AS {n}" for q, n in ((0.0, "low"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "high"))) + " FROM u WHERE v IS NOT NULL GROUP BY 1",
    "vdw_and_es": f"WITH {_BEST} SELECT name, grid_score, grid_vdw_energy, grid_es_energy FROM best ORDER BY grid_score, name LIMIT 30",
    "size_and_contribution": f"WITH {_FC}, t AS (SELECT is_ring, CAST(n_atoms AS DOUBLE) AS x, score_contribution AS y FROM v WHERE molecule_name IS NOT NULL AND isfinite(dominant_fraction) AND isfinite(score_contribution) AND fragment_label IS NOT NULL AND n_atoms IS NOT NULL AND is_ring IS NOT NULL) SELECT is_ring, count(*) AS n, round(corr(x, y), @9) AS pearson, round(regr_slope(y, x), @9) AS slope, round(regr_intercept(y, x), @9) AS intercept FROM t GROUP BY 1",
    "convergence_and_energy": f"WITH {_CONV} SELECT name, round(avg(c), @9) AS mean_convergence, round(sum(w), @9) AS sum_weight FROM w GROUP BY 1",
    "ring_and_linker": f"WITH {_FC} SELECT is_ring, count(*) AS n, round(avg(score_contribution) FILTER (isfinite(score_contribution)), @9) AS mean_contribution, round(avg(dominant_fraction) FILTER (isfinite(dominant_fraction)), @9) AS mean_convergence FROM v GROUP BY 1",
    "fragment_stack": f"WITH {_SC}, k AS (SELECT s.molecule_name, total, c, row_number() OVER (PARTITION BY s.molecule_name ORDER BY centroid_id) AS place FROM s JOIN t ON s.molecule_name = t.molecule_name) SELECT molecule_name, total, " + ", ".join(f"min(c) FILTER (place = {i}) AS f{i}" for i in range(1, 6)) + " FROM k GROUP BY 1, 2",
    "top20_druglikeness": f"WITH x AS ({_X}), o AS ({_MOL}), a AS (SELECT name, min(vina_affinity) AS vina_affinity FROM x WHERE isfinite(vina_affinity) GROUP BY 1 ORDER BY 2, 1 LIMIT 20) SELECT name, vina_affinity, " + ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in ("mw", "logp", "qed", "tpsa")) + " FROM a LEFT JOIN o USING (name)",
    "druglikeness_cards": f"WITH o AS ({_MOL}) SELECT coalesce(mw > 500 AND isfinite(mw), false)::INT + coalesce(logp > 5 AND isfinite(logp), false)::INT + coalesce(hbd > 5, false)::INT + coalesce(hba > 10, false)::INT AS violations, count(*) AS n FROM o GROUP BY 1",
    "engine_best_20": _MERGED + "SELECT consensus_rank, name, n_lists, vina_affinity, best_grid_score FROM m WHERE n_lists >= 2 ORDER BY consensus_rank LIMIT 20",
}
