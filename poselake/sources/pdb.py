"""PDB, PQR and pKa logs, by fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import lines, number, tokens, whole_files

#: Residues that are water, and kept ions.
WATER = ("HOH", "WAT", "TIP", "TIP3", "SOL")
IONS = ("ZN", "MG", "CA", "MN", "FE", "CU", "NA", "K", "CL")


def pdb_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, line_no, record, atom_name, alt_loc, res_name, chain, res_num, x, y, z, element, is_h, line): every line; fields are null outside ATOM and HETATM."""
    df = lines(whole_files(spark, path)).withColumn("record", F.trim(F.substring("line", 1, 6)))
    atom = F.col("record").isin("ATOM", "HETATM")
    text = lambda a, n: F.when(atom, F.trim(F.substring("line", a, n)))
    element = F.when(atom, F.coalesce(F.nullif(F.initcap(F.trim(F.substring("line", 77, 2))), F.lit("")), F.upper(F.regexp_extract(F.substring("line", 13, 4), "([A-Za-z])", 1))))
    out = df.select(
        "path", "line_no", "record", text(13, 4).alias("atom_name"), text(17, 1).alias("alt_loc"), text(18, 3).alias("res_name"), text(22, 1).alias("chain"), text(23, 4).try_cast("int").alias("res_num"),
        *[F.when(atom, number(F.substring("line", a, 8))).alias(c) for a, c in ((31, "x"), (39, "y"), (47, "z"))], element.alias("element"), "line",
    )
    return out.withColumn("is_h", F.coalesce(F.col("element").isin("H", "D") | F.col("atom_name").rlike("^[0-9]?[HD]"), F.lit(False)) & F.col("record").isin("ATOM", "HETATM"))


def receptor_atoms(spark: SparkSession, path: str | list[str], keep_ions: bool = True, default_chain: str = "A") -> DataFrame:
    """(residue_id, res_name, res_num, chain, atom, ord, x, y, z, element): protein atoms without water and hydrogens.

    HETATM only for ions, if ``keep_ions``; a blank chain is ``default_chain``; lines with bad numbers are left out.
    """
    df = pdb_lines(spark, path).filter(F.col("record").isin("ATOM", "HETATM") & ~F.col("res_name").isin(*WATER) & ~F.col("is_h"))
    df = df.filter((F.col("record") == "ATOM") | (F.col("res_name").isin(*IONS) if keep_ions else F.lit(False))).dropna(subset=["x", "y", "z", "res_num"])
    chain = F.when(F.col("chain") == "", default_chain).otherwise(F.col("chain"))
    return df.select(
        F.format_string("%s%d.%s", "res_name", "res_num", chain).alias("residue_id"), "res_name", "res_num", chain.alias("chain"), F.col("atom_name").alias("atom"), F.col("line_no").alias("ord"), "x", "y", "z", "element"
    )


def alpha_carbons(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, resname, resid, chain) of the CA atoms, in file order."""
    df = pdb_lines(spark, path).filter("record = 'ATOM' and atom_name = 'CA' and alt_loc in ('', 'A')")
    return df.select(F.col("line_no").alias("ordinal"), F.col("res_name").alias("resname"), F.col("res_num").alias("resid"), "chain")


def cleaned(df: DataFrame, chains: tuple[str, ...] = (), keep_water: bool = False, keep_hetero: tuple[str, ...] = IONS) -> tuple[DataFrame, DataFrame]:
    """(lines kept, counts of removed lines by reason). Reasons in order: chain, water, hetero, alt_loc.

    Of alternative locations the blank and A stay, their mark blanked. Other records stay but for CONECT, ANISOU and MASTER.
    """
    atom = F.col("record").isin("ATOM", "HETATM")
    reason = (
        F.when(~atom, F.when(F.col("record").isin("CONECT", "ANISOU", "MASTER"), "record"))
        .when(F.lit(bool(chains)) & ~F.col("chain").isin(*(chains or ("",))), "chain")
        .when(F.lit(not keep_water) & F.col("res_name").isin(*WATER), "water")
        .when((F.col("record") == "HETATM") & ~F.col("res_name").isin(*(*keep_hetero, *(WATER if keep_water else ()))), "hetero")
        .when(~F.col("alt_loc").isin("", "A"), "alt_loc")
    )
    marked = df.withColumn("reason", reason)
    kept = marked.filter("reason is null").withColumn("line", F.when(atom, F.overlay("line", F.lit(" "), 17, 1)).otherwise(F.col("line"))).drop("reason")
    return kept, marked.filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def without_hydrogens(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_h"))


def pqr_charges(spark: SparkSession, path: str) -> DataFrame:
    """(chain, res_num, atom, charge) of a PQR file; of a repeated key the last line counts. Lines without chain have ''."""
    df = lines(whole_files(spark, path)).filter(F.col("line").rlike("^(ATOM|HETATM)")).withColumn("t", tokens(F.col("line")))
    with_chain = F.get("t", 4).rlike("^[A-Za-z]$")
    chain = F.when(with_chain, F.get("t", 4)).otherwise("")
    num = F.when(with_chain, F.get("t", 5)).otherwise(F.get("t", 4)).try_cast("int")
    charge = F.get("t", F.size("t") - 2).try_cast("double")
    rows = df.select("line_no", chain.alias("chain"), num.alias("res_num"), F.get("t", 2).alias("atom"), charge.alias("charge")).filter("charge is not null and res_num is not null")
    return rows.groupBy("chain", "res_num", "atom").agg(F.max_by("charge", "line_no").alias("charge"))


def injected_charges(atoms: DataFrame, charges: DataFrame, chains: tuple[str, ...] = ("A", "B", "C", "D", "")) -> DataFrame:
    """Atoms (ord, res_num, atom, charge) with the PQR's charge, chains tried in order; their own where there is none."""
    order = F.array_position(F.array(*[F.lit(c) for c in chains]), F.col("chain"))
    best = charges.filter(F.col("chain").isin(*chains)).groupBy("res_num", "atom").agg(F.min_by("charge", order).alias("__q"))
    return atoms.join(best, ["res_num", "atom"], "left").withColumn("charge", F.coalesce("__q", "charge")).drop("__q")


def pka_table(spark: SparkSession, path: str) -> DataFrame:
    """(res_name, res_num, chain, pka) of a pKa prediction log."""
    pattern = r"^\s*(ASP|GLU|HIS|LYS|CYS|TYR)\s+(\d+)\s+([A-Za-z])\s+(-?\d+\.?\d*)"
    part = lambda k: F.regexp_extract("line", pattern, k)
    return lines(whole_files(spark, path)).filter(F.col("line").rlike(pattern)).select(part(1).alias("res_name"), part(2).cast("int").alias("res_num"), part(3).alias("chain"), part(4).cast("double").alias("pka"))
