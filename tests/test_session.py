import os
import re

from poselake import session


def test_cut_and_written_are_the_same_rows(spark, rows):
    df = spark.createDataFrame([(1, "a", [1.0]), (2, None, None)], "k int, v string, x array<double>")
    assert rows(session.cut(df), "k", "v") == rows(session.written(df), "k", "v") == [(1, "a"), (2, None)]
    assert session.written(df).schema == df.schema and session.written(df.limit(0)).count() == 0


def test_checkpoint_folder_is_the_session_s(spark):
    folder = session.checkpoint_dir(spark)
    assert folder == session.checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_written_folders_are_removed_at_the_end(spark):
    session.written(spark.range(3))
    path = re.sub("^file:(//)?", "", session._written[-1][1])
    assert os.path.isdir(path)
    kept, session._written[:] = session._written[:-1], session._written[-1:]
    session._remove_written()
    session._written[:] = kept
    assert not os.path.exists(path)
