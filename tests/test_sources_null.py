"""Rows of the cross-engine ranking without a source file count as well."""

from poselake.plans import rank_queries
from poselake.plans import tables as T

COLUMNS = "name string, source_file string, vina_affinity double, cnn_score double, cnn_affinity double, loaded_at timestamp"


def test_rows_without_a_source_file_stay(spark, tmp_path):
    rows = [("a", "f", -1.0), ("a", "f", -2.0), ("a", None, -3.0), ("b", None, -4.0), (None, "f", -9.0)]
    df = spark.createDataFrame([(n, s, v, 0.5, v) for n, s, v in rows], COLUMNS.rsplit(",", 1)[0]).selectExpr("*", "timestamp_seconds(-vina_affinity) AS loaded_at")
    df.write.parquet(f"{tmp_path}/cross_engine_ranking.parquet")
    got = {(r.name, r.source_file, r.vina_affinity) for r in T.ranking(spark, str(tmp_path), "vina_affinity").collect()}
    assert got == {("a", "f", -2.0), ("a", None, -3.0), ("b", None, -4.0)}
    assert {(r.name, r.vina_rank) for r in rank_queries.engine_ranks(spark, str(tmp_path)).collect()} == {("b", 1), ("a", 2), ("a", 3)}
