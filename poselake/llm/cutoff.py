"""Score cutoffs that keep a target share of each source's records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, written

#: Size parameter of the sketches: normalised rank error about 2.3 / k**0.9 (0.13 % at 4096), at any number of rows.
SKETCH_K = 4096
RANK_ERROR = 0.003
#: Ranks at which a sketch is read.
STEPS = 200
#: Distinct scores of a pair that one task puts in order; more are narrowed down by counts in so many bins first.
IN_ORDER, BINS = 100_000, 1024


def score_cutoffs(scores: DataFrame, targets: DataFrame, k: int = SKETCH_K, rank_error: float = RANK_ERROR) -> DataFrame:
    """One row per (source, score_name): cutoff, n_total, n_kept, n_tied, target_percent.

    ``scores``: (source, score_name, score), lower is better, finite non-null scores only count, rows
    without source are left out. ``targets``: (source, score_name, target_percent); of several targets of
    one pair the greatest counts. The cutoff is the lowest score with ``100 * kept >= target * total``;
    all scores equal to it are kept. Without a target (missing or null) the cutoff is null and nothing is
    kept; a target of 0 or less keeps the rows tied at the lowest score, one above 100 keeps all.

    Two passes. First a KLL quantile sketch per pair, built inside every partition and merged, brackets the
    score wanted between the quantiles ``rank_error`` below and above. The second pass counts rows below
    the bracket and groups only those inside it by value, so a source with a third of all rows costs no
    more than its distinct scores in a sliver of the range; where these are more than ``IN_ORDER``, counts in bins narrow
    them down before any task puts them in order. The sketch's error bound is probabilistic; the
    second pass proves every bracket by the counts on both sides, and takes pairs whose bracket missed
    through the same count over their whole range. ``scores`` is read twice.
    """
    key = ["source", "score_name"]
    clean = scores.filter(F.col("source").isNotNull() & F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") != float("inf")))
    sketches = clean.groupBy(*key).agg(F.kll_sketch_agg_double("score", F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n_total"), F.min("score").alias("low"), F.max("score").alias("high"))
    wanted = targets.filter(F.col("target_percent").isNotNull()).groupBy(*key).agg(F.max("target_percent").alias("target_percent"))
    # The function takes literal ranks only, so each sketch is asked for a grid of them at once.
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    place = F.least(F.greatest(F.col("target_percent") / 100.0, F.lit(0.0)), F.lit(1.0)) * STEPS
    low_at, high_at = F.floor(place - rank_error * STEPS).cast("int"), F.ceil(place + rank_error * STEPS).cast("int")
    bounds = (
        sketches.join(wanted, key, "left")
        .withColumn("grid", grid)
        .withColumn("from", F.when(low_at > 0, F.try_element_at("grid", low_at + 1)).otherwise(F.col("low")))
        .withColumn("to", F.when(high_at < STEPS, F.try_element_at("grid", high_at + 1)).otherwise(F.col("high")))
        .drop("sketch", "grid", "low", "high")
    )
    bounds = cut(bounds)
    first = cut(_settle(clean, bounds.filter(F.col("target_percent").isNotNull())))
    settled = first.filter("cutoff is not null")
    missed = first.filter("cutoff is null").select(*key, "n_total", "target_percent", F.lit(float("-inf")).alias("from"), F.lit(float("inf")).alias("to"))
    if missed.limit(1).count():
        settled = settled.unionByName(_settle(clean, missed))
    none = bounds.filter(F.col("target_percent").isNull()).select(*key, "n_total", "target_percent", F.lit(None).cast("double").alias("cutoff"), F.lit(0).cast("long").alias("n_kept"), F.lit(0).cast("long").alias("n_tied"))
    return settled.unionByName(none).select(*key, "target_percent", "cutoff", "n_total", "n_kept", "n_tied")


def _settle(clean: DataFrame, bounds: DataFrame) -> DataFrame:
    """Count exactly below and inside every bracket; cutoff null where the bracket doesn't hold the rank."""
    key = ["source", "score_name"]
    value = F.when(F.col("score") >= F.col("from"), F.col("score"))  # null: below the bracket
    by_value = clean.join(bounds, key).filter(F.col("score") <= F.col("to")).groupBy(*key, "n_total", "target_percent", value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    by_value = _narrowed(written(by_value))
    reached = by_value.withColumn("n_kept", F.sum("n").over(_running("value"))).withColumn("enough", _enough())
    best = F.min(F.when(F.col("enough"), F.struct(F.col("n_kept"), F.col("value"), F.col("n"))))
    whole = F.max("n_kept") >= F.max("n_total")
    out = reached.groupBy(*key, "n_total", "target_percent").agg(best.alias("best"), F.max(F.struct("n_kept", "value", "n")).alias("last"), whole.alias("whole"))
    chosen = F.coalesce(F.col("best"), F.when(F.col("whole"), F.col("last")))  # a target above 100 keeps all
    hit = chosen["value"].isNotNull()
    return bounds.select(*key).join(out, key, "left").join(bounds.select(*key, F.col("n_total").alias("_n"), F.col("target_percent").alias("_t")), key).select(
        *key, F.col("_n").alias("n_total"), F.col("_t").alias("target_percent"), F.when(hit, chosen["value"]).alias("cutoff"), F.when(hit, chosen["n_kept"]).alias("n_kept"), F.when(hit, chosen["n"]).alias("n_tied")
    )


def _running(by: str):
    return Window.partitionBy("source", "score_name").orderBy(F.col(by).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)


def _enough():
    return F.lit(100) * F.col("n_kept") >= F.col("target_percent") * F.col("n_total")


def _narrowed(by_value: DataFrame) -> DataFrame:
    """Counts by value with at most ``IN_ORDER`` values a pair: those before the bin that holds the rank are one line (value null), those after it go."""
    key = ["source", "score_name"]
    while True:
        crowded = by_value.groupBy(*key).agg(F.count("value").alias("values"), F.min("value").alias("low"), F.max("value").alias("high")).filter((F.col("values") > IN_ORDER) & (F.col("low") < F.col("high")))
        crowded = cut(crowded.select(*key, "low", "high"))
        if not crowded.limit(1).count():
            return by_value
        place = (F.col("value") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)  # halves: no overflow
        bin_ = F.when(F.col("low").isNotNull(), F.when(F.col("value").isNull(), -1).otherwise(F.least(F.floor(place * BINS), F.lit(BINS - 1)).cast("int")))
        binned = by_value.join(crowded, key, "left").withColumn("bin", bin_)
        sums = binned.filter("bin is not null").groupBy(*key, "n_total", "target_percent", "bin").agg(F.sum("n").alias("n")).withColumn("n_kept", F.sum("n").over(_running("bin")))  # at most BINS + 1 lines a pair
        chosen = sums.groupBy(*key).agg(F.coalesce(F.min(F.when(_enough(), F.col("bin"))), F.max("bin")).alias("chosen"))
        kept = binned.join(chosen, key, "left").filter("bin is null or bin <= chosen").withColumn("value", F.when(F.col("bin").isNull() | (F.col("bin") == F.col("chosen")), F.col("value")))
        by_value = written(kept.groupBy(*key, "n_total", "target_percent", "value").agg(F.sum("n").alias("n")))


def kept_rows(scores: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The rows of ``scores`` at or below their pair's cutoff."""
    return scores.join(cutoffs.filter("cutoff is not null").select("source", "score_name", "cutoff"), ["source", "score_name"]).filter(F.col("score") <= F.col("cutoff")).drop("cutoff")
