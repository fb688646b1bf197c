"""mol2 files: scored poses with header blocks, single molecules, receptors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import lines, number, numbered, stem, tokens, whole_files

_HEADER = r"(?m)^#{5,}[ \t]*([^:\n]+?)[ \t]*:[ \t]*(.*?)[ \t]*$"
#: Pose scores that become columns; any other header key stays in the map.
SCORES = {
    "Grid_Score": "grid_score", "Grid_vdw_energy": "grid_vdw_energy", "Grid_es_energy": "grid_es_energy", "Internal_energy_repulsive": "internal_energy_repulsive",
    "DOCK_Rotatable_Bonds": "dock_rotatable_bonds", "Formal_Charge": "formal_charge", "Heavy_Atoms": "heavy_atoms", "Molecular_Weight": "molecular_weight",
    "HBond_Acceptors": "hbond_acceptors", "HBond_Donors": "hbond_donors",
}


def section(block: Column, name: str) -> Column:
    """Text of ``@<TRIPOS>name`` up to the next section."""
    return F.regexp_extract(block, rf"(?s)@<TRIPOS>{name}[^\n]*\n(.*?)(?=@<TRIPOS>|\n#{{5,}}|\z)", 1)


def element(atom_type: Column) -> Column:
    """Element of a Sybyl type: what stands before the dot, capitalised."""
    return F.initcap(F.substring_index(atom_type, ".", 1))


def atoms(block: Column) -> Column:
    """array<struct<ord, atom_name, x, y, z, atom_type, element, charge, residue>>; malformed lines are left out."""
    rows = F.transform(F.filter(F.split(section(block, "ATOM"), "\n"), lambda s: F.trim(s) != ""), tokens)
    parsed = F.transform(
        F.filter(rows, lambda t: F.size(t) >= 6),
        lambda t: F.struct(
            F.get(t, 0).try_cast("int").alias("ord"), F.get(t, 1).alias("atom_name"), *[number(F.get(t, i + 2)).alias(c) for i, c in enumerate("xyz")],
            F.get(t, 5).alias("atom_type"), element(F.get(t, 5)).alias("element"), number(F.get(t, 8)).alias("charge"), F.get(t, 7).alias("residue"),
        ),
    )
    return F.filter(parsed, lambda a: a["x"].isNotNull() & a["y"].isNotNull() & a["z"].isNotNull())


def header(block: Column) -> Column:
    """map<string,string> of the header lines; of a key that comes twice the last counts."""
    keys, values = F.regexp_extract_all(block, F.lit(_HEADER), 1), F.regexp_extract_all(block, F.lit(_HEADER), 2)
    pairs = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), p["key"]))
    return F.map_from_entries(last)


def scored_poses(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """(path, pose_index, name, scores, n_atoms, atoms, block): one row per pose of scored mol2 files.

    The header block of a pose comes before its MOLECULE section and belongs to that pose. Empty files, and
    headers without a molecule, give no rows. ``name`` is the header's, else the molecule's, else the file's.
    """
    df = whole_files(spark, path, pattern)
    # Files without headers are cut at MOLECULE instead.
    bare = F.transform(F.slice(F.split("value", r"(?m)^@<TRIPOS>MOLECULE"), 2, 1 << 30), lambda s: F.concat(F.lit("@<TRIPOS>MOLECULE"), s))
    pieces = F.when(F.col("value").rlike(r"(?m)^#{5,}[ \t]*Name:"), F.split("value", r"(?m)(?=^#{5,}[ \t]*Name:)")).otherwise(bare)
    poses = numbered(df, F.filter(pieces, lambda s: s.contains("@<TRIPOS>MOLECULE")), "pose_index", "block")
    title = F.trim(F.regexp_extract("block", r"@<TRIPOS>MOLECULE[^\n]*\n([^\n]*)", 1))
    out = poses.withColumns({"scores": header(F.col("block")), "atoms": atoms(F.col("block"))})
    name = F.coalesce(F.try_element_at("scores", F.lit("Name")), F.when(title != "", title), stem(F.col("path")))
    return out.select("path", "pose_index", name.alias("name"), "scores", F.size("atoms").alias("n_atoms"), "atoms", "block")


def pose_table(poses: DataFrame) -> DataFrame:
    """The known scores as columns, every other header key in ``extra`` (map<string,string>)."""
    value = lambda k: F.try_element_at("scores", F.lit(k)).try_cast("double")
    extra = F.map_filter("scores", lambda k, v: ~k.isin("Name", *SCORES))
    return poses.select("name", "pose_index", "n_atoms", F.col("path").alias("scored_mol2"), *[value(k).alias(c) for k, c in SCORES.items()], extra.alias("extra"))


def heavy_atoms(poses: DataFrame) -> DataFrame:
    """(name, pose_index, atom_index, element, x, y, z) without hydrogens, renumbered from 0."""
    kept = F.filter("atoms", lambda a: ~a["element"].isin("H", "D"))
    return poses.select("name", "pose_index", F.posexplode(kept).alias("atom_index", "a")).select("name", "pose_index", "atom_index", "a.element", "a.x", "a.y", "a.z")


def pose_atoms(poses: DataFrame, index: int | None = None) -> DataFrame:
    """(name, pose_index, ord, atom_name, element, x, y, z) of all atoms; of pose ``index`` only if given."""
    chosen = poses if index is None else poses.filter(F.col("pose_index") == index)
    return chosen.select("name", "pose_index", F.explode("atoms").alias("a")).select("name", "pose_index", "a.ord", "a.atom_name", "a.element", "a.x", "a.y", "a.z")


def molecules(spark: SparkSession, path: str | list[str], pattern: str | None = "*.mol2") -> DataFrame:
    """(path, name, n_atoms, block) of single- or multi-molecule files."""
    return scored_poses(spark, path, pattern).select("path", "name", "n_atoms", "block")


def receptor_atoms(spark: SparkSession, path: str) -> DataFrame:
    """(residue_id, res_name, res_num, chain, atom, ord, x, y, z, element) of a receptor mol2; its chain is always A."""
    one = whole_files(spark, path).select(F.explode(atoms(F.col("value"))).alias("a"))
    name, num = F.regexp_extract("a.residue", r"^([A-Z]{1,4})(\d+)", 1), F.regexp_extract("a.residue", r"^([A-Z]{1,4})(\d+)", 2).try_cast("int")
    out = one.select(name.alias("res_name"), num.alias("res_num"), F.lit("A").alias("chain"), F.col("a.atom_name").alias("atom"), "a.ord", "a.x", "a.y", "a.z", "a.element")
    return out.filter("res_name <> ''").withColumn("residue_id", F.format_string("%s%d.%s", "res_name", "res_num", "chain"))


def substructures(spark: SparkSession, path: str) -> DataFrame:
    """(seq_id, resname) of the SUBSTRUCTURE section."""
    one = whole_files(spark, path).select(F.explode(F.split(section(F.col("value"), "SUBSTRUCTURE"), "\n")).alias("line")).select(tokens(F.col("line")).alias("t"))
    return one.filter(F.size("t") >= 2).select(F.get("t", 0).try_cast("int").alias("seq_id"), F.get("t", 1).alias("resname")).filter("seq_id is not null")


def validation(spark: SparkSession, path: str | list[str], least_atoms: int = 50) -> DataFrame:
    """One row of checks per file: sections, atoms, residues, charges, Sybyl types, their share, and ``valid``."""
    df = whole_files(spark, path).withColumns({"a": atoms(F.col("value"))})
    charges = F.transform("a", lambda x: x["charge"])
    typed = F.size(F.filter("a", lambda x: x["atom_type"].contains(".")))
    kind = F.trim(F.get(F.split(F.regexp_extract("value", r"(?s)@<TRIPOS>MOLECULE[^\n]*\n(.*)", 1), "\n"), 2))
    out = df.select(
        "path", F.col("value").contains("@<TRIPOS>ATOM").alias("has_atoms"), F.col("value").contains("@<TRIPOS>BOND").alias("has_bonds"), F.col("value").contains("@<TRIPOS>SUBSTRUCTURE").alias("has_substructure"),
        kind.alias("molecule_type"), F.size("a").alias("n_atoms"), F.size(F.array_distinct(F.transform("a", lambda x: x["residue"]))).alias("n_residues"),
        F.exists(charges, lambda c: F.abs(c) >= 1e-10).alias("has_charges"), F.round(F.aggregate(charges, F.lit(0.0), lambda s, c: s + F.coalesce(c, F.lit(0.0))), 2).alias("total_charge"),
        (typed > 0).alias("has_sybyl_types"), F.when(F.size("a") > 0, typed / F.size("a")).alias("sybyl_share"),
    )
    ok = F.col("has_atoms") & F.col("has_bonds") & F.coalesce("has_charges", F.lit(False)) & F.col("has_sybyl_types") & (F.col("n_atoms") > least_atoms)
    return out.withColumn("valid", ok)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    return lines(whole_files(spark, path))


def ligand_validation(spark: SparkSession, path: str | list[str], share: float = 0.5) -> DataFrame:
    """One row of checks per ligand file: it has atoms and bonds, charges that aren't all 0, and more than ``share`` Sybyl types."""
    df = validation(spark, path, 0)
    ok = F.col("has_atoms") & F.col("has_bonds") & (F.col("n_atoms") > 0) & F.coalesce("has_charges", F.lit(False)) & (F.coalesce("sybyl_share", F.lit(0.0)) > share)
    return df.select("path", "n_atoms", "total_charge", "sybyl_share", "has_charges", ok.alias("valid"))


def same_elements(left: DataFrame, right: DataFrame, name: str = "name") -> DataFrame:
    """(name, same): whether two sources of one molecule list the same elements in the same order; ``elements`` is an array in both."""
    b = right.select(name, F.col("elements").alias("__e"))
    return left.select(name, "elements").join(b, name).select(name, F.coalesce(F.col("elements") == F.col("__e"), F.lit(False)).alias("same"))


def synthesized_substructures(atoms: DataFrame, by: str = "path") -> DataFrame:
    """(by, text): a SUBSTRUCTURE section from (by, ord, res_num, res_name, chain) of a receptor's atoms: each residue with its first atom, numbered in order."""
    first = atoms.groupBy(by, "chain", "res_num", "res_name").agg(F.min("ord").alias("root"))
    rows = F.sort_array(F.collect_list(F.struct("root", "res_name", "res_num", "chain")))  # a receptor's residues
    line = lambda r, i: F.format_string("%6d %-8s %6d RESIDUE           4 %-1s %-4s", i + 1, F.concat(r["res_name"], r["res_num"].cast("string")), r["root"], r["chain"], r["res_name"])
    return first.groupBy(by).agg(rows.alias("r")).select(by, F.concat(F.lit("@<TRIPOS>SUBSTRUCTURE\n"), F.concat_ws("\n", F.transform("r", line)), F.lit("\n")).alias("text"))


def with_substructures(text: Column, section_text: Column) -> Column:
    """A mol2 text with its SUBSTRUCTURE section replaced, or added where there is none."""
    bare = F.regexp_replace(text, r"(?s)@<TRIPOS>SUBSTRUCTURE.*?(?=@<TRIPOS>|\z)", "")
    return F.concat(F.regexp_replace(bare, r"\n*\z", "\n"), section_text)
