"""Two engines in one table: merge, lists of the best, consensus and agreement."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import average_rank, mean_of, sequential_rank

LISTS = {"in_gnina_vina": "gnina_vina_rank", "in_gnina_composite": "gnina_composite_rank", "in_dock6_best": "dock6_best_rank", "in_dock6_mean": "dock6_mean_rank"}


def pose_statistics(poses: DataFrame, name: str = "name", score: str = "grid_score") -> DataFrame:
    """n_modes, mean, best, spread and mean / best (0 if best is 0) of every molecule's scores."""
    out = poses.filter(F.col(name).isNotNull() & F.col(score).isNotNull()).groupBy(name).agg(
        F.count(F.lit(1)).alias("n_modes"), F.avg(score).alias("mean_grid_score"), F.min(score).alias("best_grid_score"), F.max(score).alias("worst_grid_score")
    )
    best = F.col("best_grid_score")
    return out.withColumns({"spread": F.col("worst_grid_score") - best, "ratio": F.when(best == 0, F.lit(0.0)).otherwise(F.col("mean_grid_score") / best)})


def ranked(df: DataFrame, column: str, rank: str, key: str = "name") -> DataFrame:
    """Sequential rank by ``column`` ascending, nulls last, equal values by ``key``."""
    return sequential_rank(df, [F.col(column).asc_nulls_last(), F.col(key).asc_nulls_last()], rank)


def merge_engines(first: DataFrame, second: DataFrame, key: str = "name") -> DataFrame:
    """Full outer join on the molecule; null keys match nothing and stay. Clashing columns: the first engine's, else the second's."""
    both = [c for c in second.columns if c in first.columns and c != key]
    right = second.select(*[F.col(c).alias(f"__{c}") if c in both else F.col(c) for c in second.columns])
    out = first.join(right, key, "full_outer")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in both}).drop(*[f"__{c}" for c in both]) if both else out


def consensus(df: DataFrame, top_n: int = 20, lists: dict[str, str] = LISTS, key: str = "name") -> DataFrame:
    """Membership in each top-N list (a missing rank is no member), number of lists, mean and best rank, consensus rank."""
    flags = {flag: F.coalesce(F.col(rank) <= top_n, F.lit(False)) for flag, rank in lists.items()}
    out = df.withColumns(flags)
    out = out.withColumns({"n_lists": reduce(lambda a, b: a + b, [F.col(f).cast("int") for f in flags]), "avg_rank": mean_of(*lists.values()), "best_rank": F.least(*[F.col(r) for r in lists.values()])})
    return sequential_rank(out, [F.col("n_lists").desc(), F.col("avg_rank").asc_nulls_last(), F.col(key).asc_nulls_last()], "consensus_rank")


def list_overlaps(df: DataFrame, lists: dict[str, str] = LISTS) -> DataFrame:
    """(list_a, list_b, n): molecules in both lists, for every two lists; one pass."""
    pairs = list(combinations(lists, 2))
    counts = df.agg(*[F.count_if(F.col(a) & F.col(b)).alias(f"n{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("list_a"), F.lit(b).alias("list_b"), F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(pairs)])
    return counts.select(F.inline(rows))


def engine_only(df: DataFrame, own: tuple[str, ...], other: tuple[str, ...]) -> DataFrame:
    """Rows in a list of one engine and in none of the other's."""
    some = lambda names: reduce(lambda a, b: a | b, [F.col(n) for n in names])
    return df.filter(some(own) & ~some(other))


def linear_fit(df: DataFrame, x: str, y: str, least: int = 5) -> DataFrame:
    """n, Pearson's r, slope and intercept of y over x on complete rows; nulls with fewer than ``least``."""
    ok = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = ok.agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("pearson"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    enough = F.col("n") >= least
    return out.select("n", *[F.when(enough, F.col(c)).alias(c) for c in ("pearson", "slope", "intercept")])


def spearman(df: DataFrame, x: str, y: str, least: int = 6) -> DataFrame:
    """n and Spearman's rank correlation on complete rows; 0 with fewer than ``least``."""
    ok = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    both = average_rank(average_rank(ok, x, "__x"), y, "__y")
    out = both.agg(F.count(F.lit(1)).alias("n"), F.corr("__x", "__y").alias("r"))
    return out.select("n", F.when(F.col("n") >= least, F.coalesce("r", F.lit(0.0))).otherwise(0.0).alias("spearman"))


def quantile_counts(df: DataFrame, score: str, other: str, low: float = 0.3, high: float = 0.7, cut_at: float = 0.5) -> DataFrame:
    """Quadrants: rows with a score below the ``low`` quantile (strong) or above ``high`` (weak) against ``other`` > ``cut_at``.

    Quantiles are exact, linearly interpolated, over non-null scores.
    """
    q = df.agg(F.percentile(score, F.lit(low)).alias("q_low"), F.percentile(score, F.lit(high)).alias("q_high"), F.median(other).alias("median_other"))
    s, o = F.col(score), F.col(other)
    return df.crossJoin(F.broadcast(q)).agg(  # one row
        F.count_if((s < F.col("q_low")) & (o > cut_at)).alias("strong"), F.count_if((s < F.col("q_low")) & (o <= cut_at)).alias("risky"),
        F.count_if(s > F.col("q_high")).alias("weak"), F.first("q_low").alias("q_low"), F.first("q_high").alias("q_high"), F.first("median_other").alias("median_other"),
    )


def flag(column: Column) -> Column:
    """A boolean without nulls."""
    return F.coalesce(column, F.lit(False))
