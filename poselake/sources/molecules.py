"""Molecule lists: formats by suffix, tables with guessed columns, SMILES files, JSON inputs, spreadsheets."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import first_present
from ..sinks.workbook import read_workbook
from . import mol2, sdf
from .text import counted, tokens

#: Formats by suffix, and spellings of columns in order of preference.
FORMATS = {".sdf": "sdf", ".sd": "sdf", ".csv": "csv", ".tsv": "csv", ".xlsx": "xlsx", ".xls": "xlsx", ".smi": "smiles", ".smiles": "smiles", ".txt": "smiles", ".mol2": "mol2"}
SMILES_COLUMNS = ("SMILES", "Smile", "smiles", "Smiles", "smi", "canonical_smiles", "CANONICAL_SMILES")
NAME_COLUMNS = ("Name", "name", "NAME", "Molecule_Name", "ID", "id", "compound_id", "CompoundID")
PROPERTIES = ("mw", "logp", "hbd", "hba", "tpsa", "rotatable_bonds", "qed", "formal_charge", "rings", "aromatic_rings")


def detect_format(path: str) -> str:
    """``sdf``, ``csv``, ``xlsx``, ``smiles``, ``mol2``; for a folder ``mol2_dir`` (mol2 and no sdf, csv, xlsx) or ``directory``."""
    p = Path(path)
    if p.is_dir():
        kinds = set(discover(path))
        return "mol2_dir" if "mol2" in kinds and not kinds & {"sdf", "csv", "xlsx"} else "directory"
    if p.suffix.lower() not in FORMATS:
        raise ValueError(f"unsupported format {p.suffix!r}: {p.name}")
    return FORMATS[p.suffix.lower()]


def discover(folder: str) -> dict[str, list[str]]:
    """Regular files of a folder by format, sorted, not recursive."""
    out: dict[str, list[str]] = {}
    for p in sorted(Path(folder).iterdir()):
        if p.is_file() and p.suffix.lower() in FORMATS:
            out.setdefault(FORMATS[p.suffix.lower()], []).append(str(p))
    return out


def tabular(spark: SparkSession, path: str, name_column: str | None = None, smiles_column: str | None = None) -> DataFrame:
    """(name, smiles, source_file, ordinal) of a CSV or TSV; rows without a SMILES are left out, without a name get ``MOL_n``."""
    if Path(path).suffix.lower() in (".xlsx", ".xls"):
        df = spreadsheet(spark, path).withColumn("__n", F.monotonically_increasing_id())  # of one partition
    else:
        df = counted(spark.read.csv(path, header=True, sep="\t" if path.lower().endswith(".tsv") else ","), "__n")
    smiles = smiles_column or first_present(df, SMILES_COLUMNS)
    if smiles is None:
        raise ValueError(f"no SMILES column among {df.columns[:10]}")
    name = name_column or first_present(df, NAME_COLUMNS)
    text = F.trim(F.col(f"`{smiles}`").cast("string"))
    named = F.trim(F.col(f"`{name}`").cast("string")) if name else F.lit(None).cast("string")
    out = df.select(F.coalesce(F.nullif(named, F.lit("")), F.format_string("MOL_%04d", "__n")).alias("name"), text.alias("smiles"), F.lit(Path(path).name).alias("source_file"), F.col("__n").alias("ordinal"))
    return out.filter("smiles is not null and smiles <> '' and lower(smiles) <> 'nan'")


def smiles_file(spark: SparkSession, path: str) -> DataFrame:
    """(name, smiles, source_file, ordinal): ``SMILES [name]`` per line; ``#`` lines and blank ones are skipped but counted in ``SMI_n``. The file is split between tasks."""
    df = counted(spark.read.text(path), "line_no").withColumn("t", tokens(F.col("value")))
    name = F.coalesce(F.get("t", 1), F.format_string("SMI_%04d", "line_no"))
    return df.filter(~F.col("value").rlike(r"^\s*(#|$)")).select(name.alias("name"), F.get("t", 0).alias("smiles"), F.lit(Path(path).name).alias("source_file"), (F.col("line_no") + 1).alias("ordinal"))


def spreadsheet(spark: SparkSession, path: str, heading: str | None = None) -> DataFrame:
    """The first sheet of a workbook, read on the driver, as texts in one partition; ``heading``: the header is the first of ten rows holding it."""
    import pandas as pd

    rows = read_workbook(path)
    wide = max(map(len, rows), default=0)
    pdf = _under_heading(pd.DataFrame([r + [None] * (wide - len(r)) for r in rows], dtype=object), heading)
    schema = ", ".join(f"`{c}` string" for c in pdf.columns)
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in pdf.itertuples(index=False)], schema).coalesce(1)


def selection(spark: SparkSession, path: str, heading: str = "Name") -> DataFrame:
    """(name) of a selection list, a spreadsheet or CSV with up to nine lines above the heading."""
    if Path(path).suffix.lower() in (".xlsx", ".xls"):
        df = spreadsheet(spark, path, heading)
    else:
        import pandas as pd

        df = spark.createDataFrame(_under_heading(pd.read_csv(path, dtype=str, header=None, names=range(50), skip_blank_lines=False), heading).where(lambda x: x.notna(), None))
    return df.select(F.trim(heading).alias("name")).filter("name is not null and name <> ''")


def _under_heading(pdf, heading: str | None):
    for i in range(min(10, len(pdf))):
        row = [None if v is None or v != v else str(v).strip() for v in pdf.iloc[i]]
        if heading in row or heading is None:
            out = pdf.iloc[i + 1 :].reset_index(drop=True)
            out.columns = [v or f"_{k}" for k, v in enumerate(row)]
            return out[[c for c in out.columns if not c.startswith("_")]]
    raise ValueError(f"no heading {heading!r} in the first ten rows")


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """(name, smiles, source_file, source_format): every molecule of a file or folder, whatever the formats."""
    kind = detect_format(path)
    found = discover(path) if kind in ("directory", "mol2_dir") else {kind: [path]}
    parts = []
    for fmt, paths in found.items():
        for p in paths:
            if fmt == "sdf":
                df = sdf.library(spark, p).select("name", F.lit(None).cast("string").alias("smiles"), F.lit(Path(p).name).alias("source_file"))
            elif fmt == "mol2":
                df = mol2.molecules(spark, p, None).select("name", F.lit(None).cast("string").alias("smiles"), F.lit(Path(p).name).alias("source_file"))
            elif fmt == "smiles":
                df = smiles_file(spark, p).select("name", "smiles", "source_file")
            else:
                df = tabular(spark, p).select("name", "smiles", "source_file")
            parts.append(df.withColumn("source_format", F.lit(fmt)))
    if not parts:
        raise ValueError(f"nothing to read in {path}")
    return reduce(DataFrame.unionByName, parts)


def docking_inputs(spark: SparkSession, path: str) -> DataFrame:
    """Molecules of a JSON inputs file, a list or an object with ``molecules``; a molecule without a box takes the file's."""
    df = spark.read.option("multiLine", True).json(path)
    if "molecules" in df.columns:
        top = [F.col(c).alias(f"__{c}") for c in ("binding_box", "protein_pdb") if c in df.columns]
        df = df.select(*top, F.inline("molecules"))
    for c in ("binding_box", "protein_pdb"):
        if f"__{c}" in df.columns:
            df = df.withColumn(c, F.coalesce(F.col(c), F.col(f"__{c}")) if c in df.columns else F.col(f"__{c}")).drop(f"__{c}")
    return df


def with_properties(df: DataFrame, smiles: str = "smiles") -> DataFrame:
    """Chemical properties by RDKit where it is installed, else null columns."""
    try:
        from rdkit import Chem
        from rdkit.Chem import QED, Descriptors, rdMolDescriptors
    except ImportError:
        return df.withColumns({c: F.lit(None).cast("double") for c in PROPERTIES if c not in df.columns})

    def compute(batches):
        for pdf in batches:
            mols = [Chem.MolFromSmiles(t) if t else None for t in pdf[smiles]]
            how = (Descriptors.MolWt, Descriptors.MolLogP, rdMolDescriptors.CalcNumHBD, rdMolDescriptors.CalcNumHBA, rdMolDescriptors.CalcTPSA, rdMolDescriptors.CalcNumRotatableBonds, QED.qed, Chem.GetFormalCharge, rdMolDescriptors.CalcNumRings, rdMolDescriptors.CalcNumAromaticRings)
            yield pdf.assign(**{c: [None if m is None else float(f(m)) for m in mols] for c, f in zip(PROPERTIES, how)})

    kept = df.drop(*PROPERTIES)
    return kept.mapInPandas(compute, ", ".join([*(f"`{c}` {t}" for c, t in kept.dtypes), *(f"{c} double" for c in PROPERTIES)]))
