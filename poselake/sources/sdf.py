"""SDF files: molecule libraries, and poses with score properties and atom terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import number, numbered, records, stem, tokens, whole_files

#: Score properties of docked poses and the columns they become.
PROPERTIES = {"minimizedAffinity": "vina_affinity", "CNNscore": "cnn_score", "CNNaffinity": "cnn_affinity", "CNN_VS": "cnn_vs", "CNNaffinity_variance": "cnn_affinity_variance"}
TERMS = ("gauss1", "gauss2", "repulsion", "hydrophobic", "hbond")
_PROPERTY = r">[ \t]*<([^>\n]+)>[^\n]*\n([^\n]*)"


def properties(block: Column) -> Column:
    """map<string,string> of the data items' first lines; of a name that comes twice the last counts."""
    keys, values = F.regexp_extract_all(block, F.lit(_PROPERTY), 1), F.regexp_extract_all(block, F.lit(_PROPERTY), 2)
    pairs = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), F.trim(v).alias("value")))
    return F.map_from_entries(F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), p["key"])))


def atoms(block: Column) -> Column:
    """array<struct<element, x, y, z>> of a V2000 record; the counts line is sought in the first ten lines."""
    rows = F.split(block, "\n")
    head = F.slice(rows, 1, 10)
    at = F.array_position(F.transform(head, lambda s: s.contains("V2000")), True).cast("int")
    at = F.when(at > 0, at).otherwise(4)  # without the mark it is the fourth line
    n = F.coalesce(F.substring(F.get(rows, at - 1), 1, 3).try_cast("int"), F.lit(0))
    body = F.transform(F.slice(rows, at + 1, F.greatest(n, F.lit(0))), tokens)
    parsed = F.transform(F.filter(body, lambda t: F.size(t) >= 4), lambda t: F.struct(F.get(t, 3).alias("element"), *[number(F.get(t, i)).alias(c) for i, c in enumerate("xyz")]))
    return F.filter(parsed, lambda a: a["x"].isNotNull() & a["y"].isNotNull() & a["z"].isNotNull())


def atom_terms(block: Column, n_heavy: Column) -> Column:
    """array<array<double>> of the ``atomic_interaction_terms`` item: five numbers behind each ``<x,y,z>``, heavy atoms only."""
    text = F.regexp_extract(block, r"(?s)>[ \t]*<atomic_interaction_terms>[^\n]*\n(.*?)(?=\n[ \t]*\n|\n>|\z)", 1)
    rows = F.regexp_extract_all(text, F.lit(r"<[^>\n]*>((?:[ \t]+[-+0-9.eE]+){5})"), 1)
    return F.slice(F.transform(rows, lambda s: F.transform(tokens(s), lambda x: x.try_cast("double"))), 1, F.greatest(n_heavy, F.lit(0)))


def _records(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Records between ``$$$$`` lines, whatever the line ends; blank ones are left out."""
    df = records(spark, path, "$$$$", pattern).withColumn("value", F.regexp_replace("value", r"^[ \t]*\n", ""))
    return df.filter(F.col("value").rlike(r"\S"))


def library(spark: SparkSession, path: str | list[str], name_source: str = "first_word", name_property: str | None = None) -> DataFrame:
    """(path, record_no, name, rmsd, properties, block): molecules of (large) SDF files, split between tasks.

    ``name_source``: ``first_word`` or ``header`` of the title line, or ``property`` ``name_property``;
    an empty name becomes ``MOL_`` and the record's number.
    """
    df = _records(spark, path)
    df = df.withColumns({"properties": properties(F.col("value")), "title": F.trim(F.get(F.split("value", "\n"), 0))})
    name = {"first_word": F.get(tokens(F.col("title")), 0), "header": F.col("title"), "property": F.try_element_at("properties", F.lit(name_property or ""))}[name_source]
    named = F.coalesce(F.when(F.trim(name) != "", F.trim(name)), F.format_string("MOL_%04d", F.col("record_no")))
    rmsd = F.coalesce(*[F.try_element_at("properties", F.lit(k)) for k in ("rmsd", "RMSD", "Phermit_RMSD")]).try_cast("double")
    return df.select("path", "record_no", named.alias("name"), rmsd.alias("rmsd"), "properties", F.col("value").alias("block"))


def docked_poses(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """(path, name, pose_index, scores, elements, coords, atom_terms): heavy atoms and numeric properties of every pose.

    The name is the file's, without a final ``_gnina``. Records without atoms give no row; properties that
    aren't numbers are left out of ``scores``; known ones have their columns' names.
    """
    poses = _records(spark, path, pattern).withColumnsRenamed({"record_no": "pose_index", "value": "block"}).withColumn("pose_index", F.col("pose_index").cast("int"))
    names = F.create_map(*[F.lit(x) for kv in PROPERTIES.items() for x in kv])
    numeric = F.map_filter(F.transform_values(properties(F.col("block")), lambda k, v: v.try_cast("double")), lambda k, v: v.isNotNull())
    scores = F.transform_keys(numeric, lambda k, v: F.coalesce(F.try_element_at(names, k), k))
    heavy = F.filter(atoms(F.col("block")), lambda a: a["element"] != "H")
    out = poses.withColumns({"heavy": heavy, "scores": scores}).filter(F.size("heavy") > 0)
    return out.select(
        "path", F.regexp_replace(stem(F.col("path")), "_gnina$", "").alias("name"), "pose_index", "scores", F.transform("heavy", lambda a: a["element"]).alias("elements"),
        F.transform("heavy", lambda a: F.array(a["x"], a["y"], a["z"])).alias("coords"), atom_terms(F.col("block"), F.size("heavy")).alias("atom_terms"),
    )


def docked_scores(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """(name, pose_index, vina_affinity, cnn_score, cnn_affinity, cnn_vs, cnn_affinity_variance): poses with one of the first three at least."""
    df = whole_files(spark, path, pattern)
    poses = numbered(df, F.filter(F.split("value", r"\$\$\$\$\n?"), lambda s: s.rlike(r"\S")), "pose_index", "block")
    out = poses.withColumn("p", properties(F.col("block")))
    value = lambda k: F.regexp_extract(F.coalesce(F.try_element_at("p", F.lit(k)), F.lit("")), r"^([-+]?[\d.]+(?:[eE][-+]?\d+)?)", 1).try_cast("double")
    out = out.select(F.regexp_replace(stem(F.col("path")), "_gnina$", "").alias("name"), "pose_index", *[value(k).alias(c) for k, c in PROPERTIES.items()])
    return out.filter("vina_affinity is not null or cnn_score is not null or cnn_affinity is not null")


def tensors(poses: DataFrame) -> DataFrame:
    """Poses with the atom count of their molecule's first pose; others have null coordinates and terms."""
    first = poses.groupBy("name").agg(F.min_by(F.size("coords"), "pose_index").alias("n_atoms"))
    same = F.size("coords") == F.col("n_atoms")
    return poses.join(first, "name").withColumns({"coords": F.when(same, F.col("coords")), "atom_terms": F.when(same, F.col("atom_terms"))})
