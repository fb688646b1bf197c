"""Queries pN_... over the tables of a scale directory, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.residues import contact_term, residue_term
from ..operators.latest import finite, latest_rows
from ..session import written
from . import clusters, cooccurrence, cutoff, frequency, mojibake, packing, tokens, topn

#: Contacts of one result have neighbouring ids; so many of them are exchanged together.
NEAR = 4096


def _read(spark: SparkSession, sf: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet").select(*columns)


def _contacts(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Counting rows, with ``__near``: a result's contacts share it but for those at a boundary."""
    df = _read(spark, sf, "residue_contacts", "contact_id", "result_id", *columns, "loaded_at")
    return latest_rows(df, ["contact_id"], near=F.floor(F.col("contact_id") / NEAR), keep_near=True)


# 1 ------------------------------------------------------------------------------------------------
def p1_terms(spark: SparkSession, sf: str) -> DataFrame:
    df = _contacts(spark, sf, "residue_id", "contact_type")
    pairs = frequency.term_pairs(df, {"residue_id": residue_term(F.col("residue_id")), "contact_type": contact_term(F.col("contact_type"))}, F.col("result_id"), keep=("__near",))
    return frequency.term_frequencies(pairs)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_terms(spark, sf).filter("mark is not null").select("field_name", "term", "mark")


# 2 ------------------------------------------------------------------------------------------------
SCORES = ("vina_affinity", "best_grid_score")


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    df = _read(spark, sf, "cross_engine_ranking", "source_file", "name", *SCORES, "loaded_at").filter("source_file is not null")
    df = latest_rows(df, ["source_file", "name"])
    pairs = F.inline(F.array(*[F.struct(F.lit(s).alias("score_name"), finite(s).alias("score")) for s in SCORES]))
    return written(df.select(F.col("source_file").alias("source"), "name", pairs).filter("score is not null"))  # read three times


def _cutoffs(spark: SparkSession, sf: str, scores: DataFrame) -> DataFrame:
    targets = _read(spark, sf, "cutoff_targets", "source_file", "score_name", "target_percent").withColumnRenamed("source_file", "source")
    return cutoff.score_cutoffs(scores, targets)


def p2_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    return _cutoffs(spark, sf, _scores(spark, sf)).withColumnRenamed("source", "source_file")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    scores = _scores(spark, sf)
    return cutoff.kept_rows(scores, _cutoffs(spark, sf, scores)).select("score_name", F.col("source").alias("source_file"), "name")


# 3 ------------------------------------------------------------------------------------------------
def p3_best(spark: SparkSession, sf: str) -> DataFrame:
    df = _read(spark, sf, "dock6_all_poses", "name", "pose_index", "grid_score", "loaded_at").filter("name is not null")
    # A molecule's poses meet in few partitions, so that the runs made next are already complete for most.
    df = latest_rows(df, ["name", "pose_index"], near=F.xxhash64("name", F.floor(F.col("pose_index") / topn.RUN_SPAN)))
    return topn.top_n_per_group(df.select("name", "pose_index", "grid_score"), "name", "grid_score", "pose_index", 3)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_best(spark, sf).select("name", "pose_index")


# 4 ------------------------------------------------------------------------------------------------
def _baskets(spark: SparkSession, sf: str) -> DataFrame:
    results = _read(spark, sf, "fragment_contact_results", "result_id", "molecule_name", "loaded_at").filter("result_id is not null")
    results = latest_rows(results, ["result_id"]).filter("molecule_name is not null").select("result_id", "molecule_name")
    terms = _contacts(spark, sf, "residue_id").select("result_id", residue_term(F.col("residue_id")).alias("term")).filter("result_id is not null and term is not null")
    return terms.join(results, "result_id").groupBy("molecule_name").agg(F.collect_set("term").alias("items"))


def p4_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return cooccurrence.item_pairs(_baskets(spark, sf)).withColumns({"lift": F.round("lift", 6), "llr": F.round("llr", 4)})


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = cooccurrence.item_pairs(_baskets(spark, sf), min_count=5, one_in=200, min_lift=2.0)
    return pairs.select(F.col("item_a").alias("residue_a"), F.col("item_b").alias("residue_b"))


# 5 ------------------------------------------------------------------------------------------------
_XYZ = ("x", "y", "z")


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    """(kind, campaign_id, member_id, part, label, x, y, z): part is what a group needs three of."""

    def one(kind: str, table: str, key: str, position: str, part: str, label: str | None = None) -> DataFrame:
        df = latest_rows(_read(spark, sf, table, key, "campaign_id", position, part, *([label] if label else []), "loaded_at").filter(F.col(key).isNotNull()), [key])
        p = F.col(position)
        whole = df.filter(F.size(p) == 3)
        named = (F.col(label) if label else F.lit(None)).cast("string").alias("label")
        return whole.select(F.lit(kind).alias("kind"), "campaign_id", F.col(key).alias("member_id"), F.col(part).cast("string").alias("part"), named, *[finite(F.get(p, i)).alias(c) for i, c in enumerate(_XYZ)]).dropna(subset=list(_XYZ))

    return one("centroid", "fragment_centroids", "centroid_id", "centroid", "molecule_name", "fragment_label").unionByName(one("hotspot", "hotspots", "hotspot_uid", "center", "run_no"))


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.near_groups(_positions(spark, sf).drop("label"), ["kind", "campaign_id"], "member_id", _XYZ, part="part", least=3)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return _groups(spark, sf).select("kind", "first_id", "member_id")


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    """The listed groups by size, radius and most typical members."""
    return clusters.typical_members(_groups(spark, sf), ["kind", "campaign_id"], "member_id", _XYZ)


def p5_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """k-means clusters of the positions, apart by kind and campaign, by size and most typical members; equal labels draw together by up to half an Å or so."""
    rows = _positions(spark, sf).withColumn("key", F.concat_ws(":", "kind", F.col("member_id").cast("string")))
    return clusters.frame_clusters(rows, ["kind", "campaign_id"], "key", clusters.hashed_features(dict.fromkeys(_XYZ, 1.0), {"label": 0.25}, slots=4))


# 6 ------------------------------------------------------------------------------------------------
def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.encode_corpus(_read(spark, sf, "documents", "doc_id", "text"))


def p6_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by whether decoding their ids gives back the text (null: the empty text)."""
    docs = _read(spark, sf, "documents", "doc_id", "text")
    back = tokens.decode_corpus(tokens.encode_corpus(docs)).select("doc_id", "decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return docs.join(back, "doc_id").groupBy(same.alias("same")).agg(F.count(F.lit(1)).alias("n_docs"))


# 7 ------------------------------------------------------------------------------------------------
def _capacities(spark: SparkSession, sf: str) -> dict[int, int]:
    rows = _read(spark, sf, "containers", "container_id", "capacity_tokens").filter("capacity_tokens > 0").collect()  # fixed, three rows
    return {r.container_id: r.capacity_tokens for r in rows}


def p7_filled(spark: SparkSession, sf: str) -> DataFrame:
    sizes = tokens.token_counts(_read(spark, sf, "documents", "doc_id", "text"))
    out = packing.fill_containers(sizes, _capacities(spark, sf))
    return out.withColumnsRenamed({"size_from": "token_from", "size_of": "n_tokens"})


def p7_summary(spark: SparkSession, sf: str) -> DataFrame:
    sizes = tokens.token_counts(_read(spark, sf, "documents", "doc_id", "text"))
    capacities = _capacities(spark, sf)
    return packing.container_summary(packing.fill_containers(sizes, capacities), capacities)


# 8 ------------------------------------------------------------------------------------------------
def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "documents", "doc_id", "text", "source")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return mojibake.repair(_texts(spark, sf)).filter("garbled").select("doc_id")


def p8_restored(spark: SparkSession, sf: str) -> DataFrame:
    return mojibake.repair(_texts(spark, sf)).filter("garbled").select("doc_id", "restored", "n_restored", "n_lost")


def p8_ciphers(spark: SparkSession, sf: str) -> DataFrame:
    """The swaps learned for each source (null: for all): the share garbled of the runs that each can have made; ``page`` is a page of the source's own."""
    learned = mojibake.learn(_texts(spark, sf))
    schema = "source string, shown string, meant string, weight double, page string"
    pairs = F.broadcast(spark.createDataFrame([(str(k), *p) for k, p in enumerate(mojibake.swaps())], "k string, shown string, meant string"))  # a row for each swap
    own = learned.own.select("source", F.explode(F.from_json(F.get_json_object("own", "$.weights"), "map<string,double>")).alias("k", "weight")).join(pairs, "k").select("source", "shown", "meant", "weight", F.lit(None).cast("string").alias("page"))
    pages = learned.own.select("source", F.lit("own").alias("shown"), F.lit("utf_8").alias("meant"), F.lit(None).cast("double").alias("weight"), F.get_json_object("own", "$.page").alias("page")).filter("page is not null")
    general = spark.createDataFrame([(None, *mojibake.swaps()[k], float(w), None) for k, w in sorted(learned.general.items())], schema)
    return own.unionByName(pages).unionByName(general)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [p1_terms, p1_found, p2_cutoffs, p2_found, p3_best, p3_found, p4_pairs, p4_found, p5_found, p5_groups, p5_clusters, p6_ids, p6_roundtrip, p7_filled, p7_summary, p8_found, p8_restored, p8_ciphers]
    return {f.__name__: f for f in own}


# SQL ----------------------------------------------------------------------------------------------
_LATEST = "SELECT * FROM {table} QUALIFY {null} OR row_number() OVER (PARTITION BY {key} ORDER BY loaded_at DESC NULLS LAST) = 1"


def _latest(table: str, *key: str) -> str:
    return _LATEST.format(table=table, key=", ".join(key), null=" OR ".join(f"{k} IS NULL" for k in key))


_FLAT = r"trim(regexp_replace(upper(residue_id), '[\s :/_.\-,;|]+', ' ', 'g'))"
_RESIDUE = rf"""CASE WHEN {_FLAT} = '' THEN NULL
  WHEN regexp_matches({_FLAT}, '^[A-Z0-9]*[A-Z] ?0*[0-9]+ ?[A-Z]$') THEN regexp_replace({_FLAT}, '^([A-Z0-9]*[A-Z]) ?0*([0-9]+) ?([A-Z])$', '\1\2.\3')
  WHEN regexp_matches({_FLAT}, '^[A-Z0-9]*[A-Z] ?0*[0-9]+ [A-Z0-9]{{1,4}}$') THEN regexp_replace({_FLAT}, '^([A-Z0-9]*[A-Z]) ?0*([0-9]+) ([A-Z0-9]{{1,4}})$', '\1\2.\3')
  WHEN regexp_matches({_FLAT}, '^[A-Z0-9]{{1,4}} [A-Z0-9]*[A-Z] ?0*[0-9]+$') THEN regexp_replace({_FLAT}, '^([A-Z0-9]{{1,4}}) ([A-Z0-9]*[A-Z]) ?0*([0-9]+)$', '\2\3.\1')
  ELSE replace({_FLAT}, ' ', '.') END"""
_CONTACT = r"nullif(regexp_replace(regexp_replace(lower(contact_type), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), '')"

_P1 = f"""WITH c AS ({_latest("residue_contacts", "contact_id")}),
t AS (SELECT 'residue_id' AS field_name, {_RESIDUE} AS term, result_id FROM c
      UNION ALL SELECT 'contact_type', {_CONTACT}, result_id FROM c),
n AS (SELECT count(DISTINCT result_id) AS n_all FROM c),
f AS (SELECT field_name, term, count(*) AS n_occurrences, count(DISTINCT result_id) AS n_records FROM t WHERE term IS NOT NULL GROUP BY 1, 2),
m AS (SELECT f.*, CASE WHEN n_all > 0 THEN n_records / n_all END AS share,
      CASE WHEN n_records < 5 THEN 'rare' WHEN 100 * n_records > 30 * n_all THEN 'common' END AS mark FROM f, n) """

_P2 = f"""WITH r AS ({_latest("cross_engine_ranking", "source_file", "name")}),
s AS (SELECT source_file, name, 'vina_affinity' AS score_name, vina_affinity AS score FROM r
      UNION ALL SELECT source_file, name, 'best_grid_score', best_grid_score FROM r),
f AS (SELECT * FROM s WHERE source_file IS NOT NULL AND isfinite(score)),
t AS (SELECT source_file, score_name, max(target_percent) AS target_percent FROM cutoff_targets GROUP BY 1, 2),
n AS (SELECT source_file, score_name, count(*) AS n_total FROM f GROUP BY 1, 2),
v AS (SELECT source_file, score_name, score, count(*) AS n_tied FROM f GROUP BY 1, 2, 3),
c AS (SELECT *, CAST(sum(n_tied) OVER (PARTITION BY source_file, score_name ORDER BY score) AS BIGINT) AS n_kept FROM v),
b AS (SELECT source_file, score_name, min(score) AS cutoff FROM c JOIN n USING (source_file, score_name) JOIN t USING (source_file, score_name)
      WHERE 100 * n_kept >= target_percent * n_total GROUP BY 1, 2) """

_P3 = f"""WITH p AS ({_latest("dock6_all_poses", "name", "pose_index")})
SELECT {{columns}} FROM p WHERE name IS NOT NULL AND isfinite(grid_score)
QUALIFY row_number() OVER (PARTITION BY name ORDER BY grid_score, pose_index) <= 3"""

_P4 = f"""WITH c AS ({_latest("residue_contacts", "contact_id")}), r AS ({_latest("fragment_contact_results", "result_id")}),
t AS (SELECT DISTINCT molecule_name, {_RESIDUE} AS term FROM c JOIN r USING (result_id) WHERE molecule_name IS NOT NULL),
b AS (SELECT * FROM t WHERE term IS NOT NULL), n AS (SELECT count(DISTINCT molecule_name) AS n_baskets FROM b),
s AS (SELECT term, count(*) AS n FROM b GROUP BY 1),
q AS (SELECT x.term AS item_a, y.term AS item_b, count(*) AS n FROM b x JOIN b y ON x.molecule_name = y.molecule_name AND x.term < y.term GROUP BY 1, 2),
p AS (SELECT q.*, a.n AS n_a, z.n AS n_b, n_baskets, q.n * n_baskets / (CAST(a.n AS DOUBLE) * z.n) AS lift
      FROM q JOIN s a ON a.term = item_a JOIN s z ON z.term = item_b, n) """


def _cell(k: str, row: str, column: str) -> str:
    return f"CASE WHEN {k} > 0 THEN ({k}) * ln(CAST({k} AS DOUBLE) * n_baskets / (CAST({row} AS DOUBLE) * ({column}))) ELSE 0 END"


_LLR = "2 * (" + " + ".join([_cell("n", "n_a", "n_b"), _cell("n_a - n", "n_a", "n_baskets - n_b"), _cell("n_b - n", "n_baskets - n_a", "n_b"), _cell("n_baskets - n_a - n_b + n", "n_baskets - n_a", "n_baskets - n_b")]) + ")"


_POSITIONS = f"""p AS MATERIALIZED (
  SELECT 'centroid' AS kind, campaign_id, centroid_id AS id, molecule_name AS part, centroid AS c FROM ({_latest("fragment_centroids", "centroid_id")})
  UNION ALL SELECT 'hotspot', campaign_id, hotspot_uid, CAST(run_no AS VARCHAR), center FROM ({_latest("hotspots", "hotspot_uid")})),
q AS MATERIALIZED (SELECT kind, campaign_id, id, part, c[1] AS x, c[2] AS y, c[3] AS z FROM p WHERE len(c) = 3 AND isfinite(c[1]) AND isfinite(c[2]) AND isfinite(c[3])),
e AS MATERIALIZED (SELECT a.kind, a.id AS u, b.id AS v FROM q a JOIN q b ON a.kind = b.kind AND a.campaign_id IS NOT DISTINCT FROM b.campaign_id
  AND abs(a.x - b.x) <= 2.001 AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 4 + 1e-9)"""
_P5 = f"""WITH RECURSIVE {_POSITIONS},
r(kind, root, node) AS (SELECT kind, id, id FROM q UNION SELECT r.kind, r.root, e.v FROM r JOIN e ON e.kind = r.kind AND e.u = r.node),
g AS (SELECT kind, node AS member_id, min(root) AS first_id FROM r GROUP BY 1, 2),
b AS (SELECT g.kind, first_id FROM g JOIN q ON q.kind = g.kind AND q.id = g.member_id GROUP BY 1, 2 HAVING count(DISTINCT part) >= 3) """


def oracle_sql() -> dict[str, str]:
    return {
        "p5_found": _P5 + "SELECT kind, first_id, member_id FROM g JOIN b USING (kind, first_id)",
        "p5_groups": _P5 + """, m AS (SELECT q.*, first_id FROM g JOIN b USING (kind, first_id) JOIN q ON q.kind = g.kind AND q.id = g.member_id),
c AS (SELECT kind, first_id, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM m GROUP BY 1, 2),
d AS (SELECT m.*, sqrt((x - cx) ** 2 + (y - cy) ** 2 + (z - cz) ** 2) AS d FROM m JOIN c USING (kind, first_id))
SELECT kind, campaign_id, first_id, count(*) AS n_members, max(d) AS radius, list(id ORDER BY round(d, 9), id)[1:3] AS typical FROM d GROUP BY ALL""",
        "p6_roundtrip": "SELECT true AS same, count(*) AS n_docs FROM documents HAVING count(*) > 0",
        "p1_terms": _P1 + "SELECT * FROM m",
        "p1_found": _P1 + "SELECT field_name, term, mark FROM m WHERE mark IS NOT NULL",
        "p2_cutoffs": _P2 + "SELECT n.source_file, n.score_name, t.target_percent, b.cutoff, n.n_total, coalesce(c.n_kept, 0) AS n_kept, coalesce(c.n_tied, 0) AS n_tied "
        "FROM n LEFT JOIN t USING (source_file, score_name) LEFT JOIN b USING (source_file, score_name) LEFT JOIN c ON c.source_file = n.source_file AND c.score_name = n.score_name AND c.score = b.cutoff",
        "p2_found": _P2 + "SELECT score_name, source_file, name FROM f JOIN b USING (source_file, score_name) WHERE score <= cutoff",
        "p3_best": _P3.format(columns="name, pose_index, grid_score"),
        "p3_found": _P3.format(columns="name, pose_index"),
        "p4_pairs": _P4 + f"SELECT item_a, item_b, n, n_a, n_b, n_baskets, round(lift, 6) AS lift, round(CASE WHEN n * n_baskets < n_a * n_b THEN -1 ELSE 1 END * {_LLR}, 4) AS llr FROM p",
        "p4_found": _P4 + "SELECT item_a AS residue_a, item_b AS residue_b FROM p WHERE n >= 5 AND 200 * n >= n_baskets AND n * n_baskets >= 2 * n_a * n_b",
    }
