"""Session defaults and the durable folder in which lineage is cut."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "poselake") -> SparkSession:
    """A local session as used by tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``; that setting always wins. Only a local session without
    one (tests) gets a folder of its own, removed when Python ends.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("a cluster must name a shared folder in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="poselake-checkpoint-")
        atexit.register(shutil.rmtree, named, True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared folder and forget its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like :func:`cut`, but as columnar Parquet: smaller, and readers prune columns.

    The folder stays while the driver's Python runs, as plans made from the result may read it at any time; it is
    removed when Python ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/poselake-{uuid.uuid4().hex}"
    _written.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_written() -> None:
    for spark, path in _written:
        try:
            if path.startswith(("/", "file:")):
                shutil.rmtree(re.sub("^file:(//)?", "", path), ignore_errors=True)
            else:
                target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended; the cluster clears its checkpoint folder
            pass
    _written.clear()
