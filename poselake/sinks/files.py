"""Writers: tables as CSV, JSON or Parquet, structures as mol2, SDF and PDB, inputs for docking engines."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, files: int | None = None, digits: int | None = None) -> None:
    """CSV with a header; nested columns as JSON text, doubles rounded if ``digits``. ``files`` limits the number of files of small tables."""
    out = df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`") for f in df.schema.fields])
    if digits is not None:
        out = out.withColumns({f.name: F.round(F.col(f"`{f.name}`"), digits) for f in out.schema.fields if isinstance(f.dataType, T.DoubleType)})
    (out.coalesce(files) if files else out).write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str, files: int | None = None) -> None:
    """One JSON object per row; nulls are kept."""
    (df.coalesce(files) if files else df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Parquet, in folders by the columns ``by``; rows of one folder are brought together first."""
    (df.repartition(*by).write.partitionBy(*by) if by else df.write).mode("overwrite").parquet(path)


def nested(df: DataFrame, by: tuple[str, ...], name: str, order: tuple[str, ...]) -> DataFrame:
    """Rows of each group as one sorted array of structs, for JSON reports of bounded groups."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct(*order, F.struct(*rest).alias("__row")))), lambda x: x["__row"]).alias(name))


def mol2_block(name: Column, atoms: Column, bonds: Column | None = None) -> Column:
    """Text of a mol2 molecule from array<struct<atom_name, x, y, z, atom_type, charge>> and array<struct<a, b, kind>>."""
    n_bonds = F.size(bonds) if bonds is not None else F.lit(0)
    atom = lambda a, i: F.format_string("%7d %-8s%10.4f%10.4f%10.4f %-5s    1 LIG     %8.4f", i + 1, a["atom_name"], a["x"], a["y"], a["z"], a["atom_type"], F.coalesce(a["charge"], F.lit(0.0)))
    parts = [F.lit("@<TRIPOS>MOLECULE"), name, F.format_string("%d %d 1 0 0", F.size(atoms), n_bonds), F.lit("SMALL"), F.lit("USER_CHARGES"), F.lit(""), F.lit("@<TRIPOS>ATOM"), F.concat_ws("\n", F.transform(atoms, atom))]
    if bonds is not None:
        bond = lambda b, i: F.format_string("%6d%6d%6d %s", i + 1, b["a"], b["b"], b["kind"])
        parts += [F.lit("@<TRIPOS>BOND"), F.concat_ws("\n", F.transform(bonds, bond))]
    return F.concat(F.concat_ws("\n", *parts), F.lit("\n"))


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_")


def write_blocks(df: DataFrame, folder: str, name: str, block: str, suffix: str) -> DataFrame:
    """(name, path) after writing each row's text to ``folder/name.suffix``, a folder all executors share.

    A file is written beside its place and then moved, so a task that runs twice leaves one whole file.
    """
    folder = re.sub(r"^file:(//)?", "", folder)
    os.makedirs(folder, exist_ok=True)

    def write(batches):
        import pandas as pd

        for pdf in batches:
            paths = []
            for key, text in zip(pdf["name"], pdf["text"]):
                path = f"{folder}/{key}{suffix}"
                part = f"{path}.{os.getpid()}.part"
                with open(part, "w", encoding="utf-8") as f:
                    f.write(text)
                os.replace(part, path)
                paths.append(path)
            yield pd.DataFrame({"name": pdf["name"], "path": paths})

    rows = df.filter(F.col(block).isNotNull()).select(safe_name(F.col(name)).alias("name"), F.col(block).alias("text"))
    return rows.mapInPandas(write, "name string, path string")


def best_pose_blocks(poses: DataFrame, score: str = "Grid_Score") -> DataFrame:
    """(name, block): the text of each molecule's best pose, from scored mol2 poses."""
    value = F.try_element_at("scores", F.lit(score)).try_cast("double")
    return poses.withColumn("__s", value).filter("__s is not null").groupBy("name").agg(F.min_by("block", F.struct("__s", "pose_index")).alias("block"))


def sdf_text(df: DataFrame, block: str = "block") -> DataFrame:
    """Records as they came, ready to be joined: each ends with ``$$$$``."""
    return df.withColumn(block, F.concat(F.regexp_replace(F.col(block), r"\n*\z", ""), F.lit("\n$$$$\n")))


def pdb_text(kept: DataFrame) -> DataFrame:
    """(path, text): the lines of each file in order; one receptor's lines fit a row."""
    return kept.groupBy("path").agg(F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])).alias("text"))


def docking_inputs(molecules: DataFrame, receptor: str, box: DataFrame, metadata: tuple[str, ...] = (), control: DataFrame | None = None) -> DataFrame:
    """(name, json): inputs of a docking engine, the box (one row) in each; ``control`` rows are marked as reference."""
    rows = molecules.withColumns({"is_reference": F.lit(False), "strategy": F.lit(None).cast("string")})
    if control is not None:
        rows = rows.unionByName(control.withColumns({"is_reference": F.lit(True), "strategy": F.lit("reference_control")}), allowMissingColumns=True)
    one = box.select(F.struct(*box.columns).alias("binding_box"))
    meta = F.struct(*[F.col(c) for c in (*metadata, "is_reference", "strategy")])
    body = F.struct("name", F.lit(receptor).alias("protein_pdb"), "ligand_file", F.lower(F.regexp_extract("ligand_file", r"\.([^.]+)$", 1)).alias("ligand_format"), "smiles", "binding_box", meta.alias("metadata"))
    return rows.crossJoin(F.broadcast(one)).select("name", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))  # box: one row


def parameter_file(values: Mapping[str, object], width: int = 60) -> str:
    """Engine input text, a parameter a line; booleans as yes and no, parameters without a value left out."""
    shown = {k: ("yes" if v is True else "no" if v is False else v) for k, v in values.items() if v is not None}
    return "".join(f"{k:<{width}} {v}\n" for k, v in shown.items())


def with_parameters(template: str, values: Mapping[str, object]) -> str:
    """A user's parameter file with some values replaced, unknown parameters added at its end."""
    left = dict(values)
    out = []
    for line in template.splitlines():
        key = line.split(None, 1)[0] if line.strip() else ""
        out.append(parameter_file({key: left.pop(key)}).rstrip("\n") if key in left else line)
    return "\n".join(out) + "\n" + parameter_file(left)


def sphere_input(surface: str, spheres: str, receptor: bool = True, close: float = 0.0, largest: float = 4.0, smallest: float = 1.4) -> str:
    """Input of the sphere generator: surface, side, points, closeness, radii, output."""
    return "\n".join([surface, "R" if receptor else "L", "X", str(close), str(largest), str(smallest), spheres]) + "\n"


def short_paths(paths: Mapping[str, str], folder: str, longest: int = 80) -> dict[str, str]:
    """Paths an engine with a length limit can read: links in ``folder`` for those that are too long."""
    out = {}
    for key, path in paths.items():
        if len(path) > longest:
            link = Path(folder) / f"{key}{Path(path).suffix}"
            if link.is_symlink() or link.exists():
                link.unlink()
            link.symlink_to(os.path.abspath(path))
            path = str(link)
        out[key] = path
    return out


def viewer_script(spots: list[tuple[float, float, float, float]], colour: str = "orange", transparency: float = 0.5) -> str:
    """A ``.bild`` scene of spheres (x, y, z, radius)."""
    return f".color {colour}\n.transparency {transparency}\n" + "".join(f".sphere {x:.3f} {y:.3f} {z:.3f} {r:.2f}\n" for x, y, z, r in spots)


def text_summary(df: DataFrame, title: str, k: int = 20) -> str:
    """A fixed-width report of the first ``k`` rows: only those reach the driver."""
    rows = [df.columns, *[["" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v) for v in r] for r in df.limit(k).collect()]]
    width = [max(len(r[i]) for r in rows) for i in range(len(df.columns))]
    body = ["  ".join(v.ljust(w) for v, w in zip(r, width)).rstrip() for r in rows]
    return "\n".join([title, "=" * len(title), body[0], "-" * len(body[0]), *body[1:]]) + "\n"


def html_table(df: DataFrame, title: str, k: int = 50) -> str:
    """The first ``k`` rows as a HTML table."""
    from html import escape

    head = "".join(f"<th>{escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{'' if v is None else escape(f'{v:.3f}' if isinstance(v, float) else str(v))}</td>" for v in r) + "</tr>" for r in df.limit(k).collect())
    return f"<h2>{escape(title)}</h2><table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"
