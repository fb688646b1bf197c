"""Scans of the text formats as they stand in the documents, and counts of job outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.external import status_counts
from ..sources.mol2 import header
from ..sources.reports import stdout_modes
from . import tables as T
from .sql import r


def _texts(spark: SparkSession, sf: str, source: str) -> DataFrame:
    df = T.raw(spark, sf, "documents", "doc_id", "text", "source").filter((F.col("source") == source) & F.col("text").isNotNull())
    return df.withColumn("text", F.regexp_replace("text", "\r\n?", "\n"))


def stdout_modes_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Score tables in engine output."""
    return _texts(spark, sf, "engine_stdout").select("doc_id", F.inline(stdout_modes(F.col("text"))))


def best_mode_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    """First mode and number of modes of each output."""
    df = stdout_modes_of_documents(spark, sf)
    return df.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_modes"), F.min("vina_affinity").alias("best_vina"), F.max("cnn_score").alias("best_cnn"))


def mol2_headers_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Poses in scored mol2 texts: one row per header block with its name and scores."""
    blocks = F.filter(F.split("text", r"(?m)(?=^#{5,}[ \t]*Name:)"), lambda s: s.rlike(r"^#{5,}[ \t]*Name:"))
    df = _texts(spark, sf, "scored_mol2_headers").select("doc_id", F.posexplode(blocks).alias("pose_index", "block")).withColumn("h", header(F.col("block")))
    value = lambda k: F.try_element_at("h", F.lit(k))
    return df.select("doc_id", "pose_index", value("Name").alias("name"), value("Grid_Score").try_cast("double").alias("grid_score"), value("Grid_vdw_energy").try_cast("double").alias("grid_vdw_energy"))


def poses_per_text(spark: SparkSession, sf: str) -> DataFrame:
    """Molecule sections counted by text."""
    df = _texts(spark, sf, "scored_mol2_headers")
    return df.select("doc_id", F.regexp_count("text", F.lit("@<TRIPOS>MOLECULE")).cast("long").alias("n_molecules"))


def job_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as jobs: outcomes, total and mean run time."""
    e = T.raw(spark, sf, "events", "event_id", "event_type", "value")
    status = F.when(F.col("event_type") == "click", "OK").when(F.col("event_type") == "view", "FAILED").when(F.col("event_type") == "purchase", "TIMEOUT").otherwise("DRY_RUN")
    return r(status_counts(e.select(status.alias("status"), F.col("value").alias("runtime_sec"))), "total_sec", "mean_sec", digits=5)


def residues_by_number(spark: SparkSession, sf: str) -> DataFrame:
    """The receptor's residues by the number in their id."""
    rec = T.raw(spark, sf, "receptor_residues", "residue_id")
    return rec.withColumn("number", F.regexp_extract("residue_id", r"(\d+)", 1).cast("int")).orderBy("number", "residue_id")


QUERIES = [stdout_modes_of_documents, best_mode_of_documents, mol2_headers_of_documents, poses_per_text, job_outcomes, residues_by_number]

_LINES = r"""l AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS line FROM documents WHERE source = 'engine_stdout' AND text IS NOT NULL),
t AS (SELECT doc_id, string_split_regex(regexp_replace(line, '^ +| +$', '', 'g'), '\s+') AS t FROM l WHERE NOT regexp_matches(line, '^\s*(#|mode|-*\+?-{3}|$)')),
m AS (SELECT doc_id, TRY_CAST(t[1] AS INT) AS mode, TRY_CAST(t[2] AS DOUBLE) AS vina_affinity, TRY_CAST(CASE WHEN len(t) >= 5 THEN t[len(t) - 1] ELSE t[3] END AS DOUBLE) AS cnn_score,
 TRY_CAST(CASE WHEN len(t) >= 5 THEN t[len(t)] ELSE t[4] END AS DOUBLE) AS cnn_affinity FROM t WHERE len(t) >= 4 AND regexp_matches(t[1], '^[-+]?[0-9]+$')), o AS (SELECT * FROM m WHERE mode IS NOT NULL AND vina_affinity IS NOT NULL)"""
SQL = {
    "stdout_modes_of_documents": f"WITH {_LINES} SELECT * FROM o",
    "best_mode_of_documents": f"WITH {_LINES} SELECT doc_id, count(*) AS n_modes, min(vina_affinity) AS best_vina, max(cnn_score) AS best_cnn FROM o GROUP BY 1",
    "poses_per_text": "SELECT doc_id, CAST((length(text) - length(replace(text, '@<TRIPOS>MOLECULE', ''))) / 17 AS BIGINT) AS n_molecules FROM documents WHERE source = 'scored_mol2_headers' AND text IS NOT NULL",
    "job_outcomes": """WITH s AS (SELECT CASE event_type WHEN 'click' THEN 'OK' WHEN 'view' THEN 'FAILED' WHEN 'purchase' THEN 'TIMEOUT' ELSE 'DRY_RUN' END AS s, value AS v FROM events)
SELECT count(*) AS n, count(*) FILTER (s = 'OK') AS n_ok, count(*) FILTER (s = 'FAILED') AS n_failed, count(*) FILTER (s = 'TIMEOUT') AS n_timeout, count(*) FILTER (s = 'DRY_RUN') AS n_dry_run, round(sum(v), @5) AS total_sec, round(avg(v) FILTER (s = 'OK'), @5) AS mean_sec FROM s""",
    "residues_by_number": r"SELECT residue_id, CAST(regexp_extract(residue_id, '(\d+)', 1) AS INT) AS number FROM receptor_residues",
    "mol2_headers_of_documents": r"""WITH d AS (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS t FROM documents WHERE source = 'scored_mol2_headers' AND text IS NOT NULL),
l AS (SELECT doc_id, unnest(t) AS line, generate_subscripts(t, 1) AS i FROM d),
b AS (SELECT *, count(*) FILTER (regexp_matches(line, '^#{5,}[ \t]*Name:')) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS block FROM l),
k AS (SELECT doc_id, block, i, regexp_extract(line, '^#{5,}[ \t]*([^:]+?)[ \t]*:[ \t]*(.*?)[ \t]*$', ['key', 'value']) AS h FROM b WHERE block >= 0 AND regexp_matches(line, '^#{5,}[ \t]*([^:]+?)[ \t]*:'))
SELECT doc_id, CAST(block AS INT) AS pose_index, arg_max(h.value, i) FILTER (h.key = 'Name') AS name, TRY_CAST(arg_max(h.value, i) FILTER (h.key = 'Grid_Score') AS DOUBLE) AS grid_score,
 TRY_CAST(arg_max(h.value, i) FILTER (h.key = 'Grid_vdw_energy') AS DOUBLE) AS grid_vdw_energy FROM k GROUP BY 1, 2""",
}
