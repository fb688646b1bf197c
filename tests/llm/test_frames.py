from pyspark.sql import functions as F

from poselake.llm import clusters


def test_clusters_stay_in_their_frame(spark):
    data = [(kind, c, f"{kind}:{c}:{i}", float(i % 4) * 50 + i * 0.01, 0.0, 0.0) for kind in ("centroid", "hotspot") for c in [*range(100), None] for i in range(8)]
    df = spark.createDataFrame(data, "kind string, campaign_id int, key string, x double, y double, z double")
    got = clusters.frame_clusters(df, ["kind", "campaign_id"], "key", F.array("x", "y", "z")).collect()
    assert sum(r.n_members for r in got) == len(data) and len({(r.kind, r.campaign_id) for r in got}) == 202
    assert all(m.rsplit(":", 1)[0] == f"{r.kind}:{r.campaign_id}" for r in got for m in r.typical)
    assert all(sum(1 for r in got if (r.kind, r.campaign_id) == s) == 2 for s in {(r.kind, r.campaign_id) for r in got})  # ceil(sqrt(8 / 2))
    assert clusters.frame_clusters(df.limit(0), ["kind", "campaign_id"], "key", F.array("x", "y", "z")).count() == 0
