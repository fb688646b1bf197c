"""Best rows, ranks and firsts: one exchange per group key, and no global window in a single task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.classify import dominance
from ..session import cut


def best_rows(df: DataFrame, group: str, score: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the lowest ``score`` of every group; equal scores by ``ties``. Null groups and scores are left out."""
    w = Window.partitionBy(group).orderBy(F.col(score), *[F.col(t).asc_nulls_last() for t in ties])
    ok = df.filter(F.col(group).isNotNull() & F.col(score).isNotNull())
    return ok.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def sequential_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Ranks 1..n in ``order``, which must tell all rows apart for a repeatable result.

    Rows are range-partitioned and sorted; a rank is the row's place in its partition plus the rows of the
    partitions before. Only one count per partition is exchanged after the sort.
    """
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    base = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__base"))
    ranked = placed.withColumn("__part", part).join(F.broadcast(base), "__part")  # a row per partition
    return ranked.withColumn(name, (F.col("__base") + place + 1).cast("long")).drop("__part", "__base", "__at")


def competition_ranks(df: DataFrame, ranks: Mapping[str, tuple[Column, bool]]) -> DataFrame:
    """``df`` with columns ``rank(method="min")``, each of a numeric expression, ascending or not: 1 + the rows strictly before; null for null values.

    Counted over distinct values, all rankings in one exchange: equal rows share one line of it however
    many they are. Prefix sums go by range partitions, so no task sees a whole ranking.
    """
    signed = {name: (value if ascending else -value).cast("double") for name, (value, ascending) in ranks.items()}
    keyed = df.withColumns({f"__{name}": value + F.lit(0.0) for name, value in signed.items()})
    values = keyed.select(F.inline(F.array(*[F.struct(F.lit(name).alias("which"), F.col(f"__{name}").alias("v")) for name in ranks]))).filter("v is not null")
    counts = values.groupBy("which", "v").agg(F.count(F.lit(1)).alias("n"))
    placed = cut(counts.repartitionByRange("which", "v").withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("which").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    base = placed.groupBy("which", "part").agg(F.sum("n").alias("n")).select("which", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = F.coalesce(F.sum("n").over(Window.partitionBy("which", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = placed.withColumn("own", own).join(F.broadcast(base), ["which", "part"]).select("which", "v", (F.col("base") + F.col("own") + 1).cast("long").alias("rank"))
    for name in ranks:
        # Rows without a value match nothing: a hash spreads them, or they would all meet in one task.
        spread = F.when(F.col(f"__{name}").isNull(), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if _hashable(df.schema[c].dataType)])).otherwise(F.lit(0).cast("long"))
        found_one = found.filter(F.col("which") == name).select(F.col("v").alias(f"__{name}"), F.lit(0).cast("long").alias("__spread"), F.col("rank").alias(name))
        keyed = keyed.withColumn("__spread", spread).join(found_one, [f"__{name}", "__spread"], "left").drop("__spread")
    return keyed.select(*df.columns, *ranks)


def _hashable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType, T.StructType, T.ArrayType))


def competition_rank(df: DataFrame, value: str, name: str, ascending: bool = True) -> DataFrame:
    """One ranking; see :func:`competition_ranks`."""
    return competition_ranks(df, {name: (F.col(value), ascending)})


def average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Mean rank of equal values (for rank correlations); null for null values."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("__ties"))
    ranked = competition_rank(df, value, "__min")
    return ranked.join(counts, value, "left").withColumn(name, F.col("__min") + (F.col("__ties") - 1) / 2.0).select(*df.columns, name)


def score_ranking(poses: DataFrame, name: str = "name", score: str = "grid_score", vdw: str = "grid_vdw_energy", es: str = "grid_es_energy", pose: str = "pose_index", top_n: int = 0) -> DataFrame:
    """Best pose of every molecule with the statistics of all its poses, ranked by the best score.

    ``vdw_fraction`` and ``es_fraction`` are shares of the best score (0 if it is 0, null if the energy is
    missing); ``std_score`` is the population's. One exchange by molecule: best row and statistics come
    from the same aggregation. ``top_n`` of 0 keeps all.
    """
    ok = poses.filter(F.col(name).isNotNull() & F.col(score).isNotNull())
    best = F.min_by(F.struct(score, vdw, es), F.struct(score, pose))
    stats = ok.groupBy(name).agg(best.alias("b"), F.count(F.lit(1)).alias("n_poses"), F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"), F.max(score).alias("worst_score"))
    s, v, e = (F.col(f"b.{c}") for c in (score, vdw, es))
    share = lambda part: F.when(part.isNotNull(), F.when(s == 0, F.lit(0.0)).otherwise(part / s))
    out = stats.select(
        name, s.alias(score), v.alias(vdw), e.alias(es), share(v).alias("vdw_fraction"), share(e).alias("es_fraction"), dominance(v, e).alias("dominance"),
        "n_poses", "mean_score", "std_score", "worst_score", (F.col("worst_score") - s).alias("score_range"),
    )
    ranked = sequential_rank(out, [F.col(score).asc(), F.col(name).asc()])
    return ranked.filter(F.col("rank") <= top_n) if top_n else ranked


def engine_ranks(results: DataFrame, vina: str = "vina_affinity", cnn_score: str = "cnn_score", cnn_affinity: str = "cnn_affinity", success: str = "success", rank_by: str = "vina_affinity", top_n: int = 10) -> DataFrame:
    """Competition ranks of successful rows by three scores, the rank of their mean, and the top-N flag.

    Affinities rank ascending, the CNN score descending. The mean takes the ranks there are. Rows without
    success, and missing scores, have null ranks and no flag. ``rank_by`` names the score behind the flag, or
    ``consensus``.
    """
    good = lambda c: F.when(F.col(success), F.col(c))
    names = ("vina_rank", "cnn_score_rank", "cnn_affinity_rank")
    out = competition_ranks(results, {"vina_rank": (good(vina), True), "cnn_score_rank": (good(cnn_score), False), "cnn_affinity_rank": (good(cnn_affinity), True)})
    out = out.withColumn("__mean", mean_of(*names))
    out = competition_rank(out, "__mean", "consensus_rank").drop("__mean")
    primary = {vina: "vina_rank", cnn_score: "cnn_score_rank", cnn_affinity: "cnn_affinity_rank"}.get(rank_by, "consensus_rank")
    return out.withColumn("is_top_n", F.coalesce(F.col(primary) <= top_n, F.lit(False)))


def mean_of(*columns: str) -> Column:
    """Row-wise mean of the values that aren't null; null if there is none."""
    some = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda x: x.isNotNull())
    return F.when(F.size(some) > 0, F.aggregate(some, F.lit(0.0), lambda a, x: a + x) / F.size(some))


def is_reference(flag: Column, strategy: Column | None = None) -> Column:
    """Whether a row is the reference control: by its flag, or by its strategy."""
    out = F.coalesce(flag, F.lit(False))
    return out | F.coalesce(strategy == "reference_control", F.lit(False)) if strategy is not None else out


def conformers(molecules: DataFrame, name: str = "name", rmsd: str = "rmsd", order: str = "ordinal", strategy: str = "best_rmsd") -> DataFrame:
    """One row per molecule (``best_rmsd``: lowest non-null, else first; ``first``) or ``all``, with ``group_size``."""
    if strategy not in ("best_rmsd", "first", "all"):
        raise ValueError(f"unknown strategy {strategy!r}")
    whole = Window.partitionBy(name)
    sized = molecules.withColumn("group_size", F.count(F.lit(1)).over(whole))
    if strategy == "all":
        return sized
    by = [F.col(rmsd).asc_nulls_last()] if strategy == "best_rmsd" else []
    return sized.withColumn("__n", F.row_number().over(whole.orderBy(*by, F.col(order).asc()))).filter("__n = 1").drop("__n")


def mark_duplicates(df: DataFrame, key: str = "smiles", name: str = "name", order: str = "ordinal", into: str = "duplicate_of") -> DataFrame:
    """Flag, don't drop: rows whose ``key`` occurred before (by ``order``) name the first row's ``name``.

    The firsts come from an aggregation that combines in every partition, so a key shared by a third of the
    rows isn't gathered anywhere. Null keys are no duplicates.
    """
    first = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(order, name)).alias("__first"))
    joined = df.join(first, key, "left")
    later = F.struct(F.col(order), F.col(name)) > F.col("__first")
    return joined.withColumn(into, F.when(later, F.col(f"__first.{name}"))).select(*df.columns, into)


def lowest(df: DataFrame, column: str, k: int, ties: Sequence[str] = (), largest: bool = False) -> DataFrame:
    """The k rows with the smallest (largest) values, nulls dropped: a top-k report."""
    by = F.col(column).desc() if largest else F.col(column).asc()
    return df.filter(F.col(column).isNotNull()).orderBy(by, *ties).limit(k)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, into: str = "place") -> DataFrame:
    """The first k rows of each group; Spark ends a group after k rows before the exchange, too."""
    return df.withColumn(into, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(into) <= k).withColumn(into, F.col(into).cast("long"))
