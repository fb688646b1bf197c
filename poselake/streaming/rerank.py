"""Rankings kept up to date while poses arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def best_so_far(poses: DataFrame, late: str = "10 minutes", window: str = "1 hour", time: str = "arrived_at") -> DataFrame:
    """Best score and number of poses of each molecule and window of arrival, of a stream (name, grid_score, ``time``).

    Late rows count until the watermark passes their window; then the window's state is dropped. Non-finite scores are left out.
    """
    ok = poses.filter(F.col("name").isNotNull() & F.col("grid_score").isNotNull() & ~F.isnan("grid_score") & (F.abs("grid_score") != float("inf")))
    return ok.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), "name").agg(F.min("grid_score").alias("best_score"), F.count(F.lit(1)).alias("n_poses")).select("w.start", "w.end", "name", "best_score", "n_poses")


def keep_best(poses: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Upsert each micro-batch into a Parquet table of best poses by molecule.

    A batch writes its own folder, named by its number, so a batch that runs again replaces its own rows only;
    :func:`current_best` reads the best over all folders.
    """

    def write(batch: DataFrame, number: int) -> None:
        best = batch.filter("name is not null and grid_score is not null and not isnan(grid_score)").groupBy("name").agg(F.min_by(F.struct("pose_index", "grid_score"), F.struct("grid_score", "pose_index")).alias("b"))
        best.select("name", "b.pose_index", "b.grid_score").write.mode("overwrite").parquet(f"{target}/batch={number}")

    return poses.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_best(spark, target: str) -> DataFrame:
    """(name, pose_index, grid_score) over all batches."""
    df = spark.read.parquet(target)
    return df.groupBy("name").agg(F.min_by(F.struct("pose_index", "grid_score"), F.struct("grid_score", "pose_index")).alias("b")).select("name", "b.pose_index", "b.grid_score")
