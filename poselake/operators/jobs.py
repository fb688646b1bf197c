"""Jobs for external programs, prepared as rows: (name, output, input_path, input_text, command).

Texts and commands are column expressions, so preparing a million jobs is one scan; nothing here needs the
programs. :func:`run_prepared` writes the inputs and runs the commands, or only says what would be run.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.files import parameter_file
from .external import run_jobs

# Parameters of the grid docking engine's input files, and their defaults.
_SEARCH = {
    "use_internal_energy": True, "internal_energy_rep_exp": 12, "internal_energy_cutoff": 100.0, "ligand_atom_file": "{ligand}", "limit_max_ligands": False, "skip_molecule": False,
    "read_mol_solvation": False, "calculate_rmsd": False, "use_database_filter": False,
}
_GROWTH = {
    "user_specified_anchor": False, "limit_max_anchors": False, "min_anchor_size": 5, "pruning_use_clustering": True, "pruning_max_orients": 1000, "pruning_clustering_cutoff": 100,
    "pruning_conformer_score_cutoff": 100.0, "pruning_conformer_score_scaling_factor": 1.0, "use_clash_overlap": False, "write_growth_tree": False,
}
_ORIENT = {"orient_ligand": True, "automated_matching": True, "receptor_site_file": "{spheres}", "max_orientations": 1000, "critical_points": False, "chemical_matching": False, "use_ligand_spheres": False}
_GRID = {"contact_score_primary": False, "grid_score_primary": True, "grid_score_rep_rad_scale": 1, "grid_score_vdw_scale": 1, "grid_score_es_scale": 1, "grid_score_grid_prefix": "{grid}"}
_SOLVENT = {"gbsa_hawkins_score_rec_filename": "{receptor}", "gbsa_hawkins_score_solvent_dielectric": 78.5, "gbsa_hawkins_use_salt_screen": False, "gbsa_hawkins_score_gb_offset": 0.09, "gbsa_hawkins_score_cont_vdw_and_es": True, "gbsa_hawkins_score_vdw_att_exp": 6, "gbsa_hawkins_score_vdw_rep_exp": 12, "grid_score_rep_rad_scale": 1}
_MINIMIZE = {
    "minimize_ligand": True, "simplex_max_iterations": 500, "simplex_tors_premin_iterations": 0, "simplex_max_cycles": 1, "simplex_score_converge": 0.1, "simplex_cycle_converge": 1.0,
    "simplex_trans_step": 1.0, "simplex_rot_step": 0.1, "simplex_tors_step": 10.0, "simplex_random_seed": 0, "simplex_restraint_min": False,
}
_OUTPUT = {"ligand_outfile_prefix": "{prefix}", "write_orientations": False, "num_scored_conformers": 1, "rank_ligands": False}
_GRID_FILE = {
    "compute_grids": True, "grid_spacing": 0.3, "output_molecule": False, "contact_score": False, "energy_score": True, "energy_cutoff_distance": 9999, "atom_model": "a", "attractive_exponent": 6, "repulsive_exponent": 12,
    "distance_dielectric": True, "dielectric_factor": 4, "bump_filter": True, "bump_overlap": 0.75, "allow_non_integral_charges": True,
}


def docking_parameters(flexible: bool = True, solvent: bool = False, footprint: bool = False, definitions: Mapping[str, str] | None = None, settings: Mapping[str, object] | None = None) -> str:
    """Input of the grid docking engine with the places {ligand}, {prefix}, {spheres}, {grid}, {receptor} and {reference} left open.

    ``footprint`` scores the ligand as it lies by residue instead of docking it. ``settings`` replace defaults; a null leaves a parameter out.
    """
    values: dict[str, object] = {"conformer_search_type": "flex" if flexible and not footprint else "rigid"}
    values |= (_GROWTH if flexible and not footprint else {}) | _SEARCH
    values |= {"orient_ligand": False} if footprint else _ORIENT
    values |= {"bump_filter": False, "score_molecules": True}
    if footprint:
        values |= {"use_internal_energy": False, "contact_score_primary": False, "grid_score_primary": False, "footprint_similarity_score_primary": True, "fps_score_use_footprint_reference_mol2": True, "fps_score_footprint_reference_mol2_filename": "{reference}", "fps_score_receptor_filename": "{receptor}", "fps_score_vdw_att_exp": 6, "fps_score_vdw_rep_exp": 12}
    else:
        values |= _GRID | ({"gbsa_hawkins_score_secondary": True} | _SOLVENT if solvent else {"gbsa_hawkins_score_secondary": False}) | _MINIMIZE
    values |= {"atom_model": "all", **(definitions or {}), **_OUTPUT}
    if footprint:
        values |= {"minimize_ligand": False, "write_footprints": True}
    return parameter_file(values | dict(settings or {}))


def grid_parameters(receptor: str, box: str, definitions: str, prefix: str, settings: Mapping[str, object] | None = None) -> str:
    """Input of the grid generator."""
    return parameter_file(_GRID_FILE | dict(settings or {}) | {"receptor_file": receptor, "box_file": box, "vdw_definition_file": definitions, "score_grid_prefix": prefix}, 30)


def box_input(spheres: str, box: str, margin: float = 8.0) -> str:
    """Answers for the box program: from spheres, margin, sphere file, the first cluster, output."""
    return f"Y\n{margin}\n{spheres}\n1\n{box}\n"


def _filled(template: str, values: Mapping[str, Column | str]) -> Column:
    out: Column = F.lit(template)
    for key, value in values.items():
        out = F.replace(out, F.lit("{" + key + "}"), F.lit(value) if isinstance(value, str) else value)
    return out


def _path(folder: str, name: Column, suffix: str) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_"), F.lit(suffix))


def docking_jobs(ligands: DataFrame, folder: str, template: str, files: Mapping[str, str], program: str = "dock6", suffix: str = "_scored.mol2") -> DataFrame:
    """A job per (name, ligand_file): its input from ``template`` (see :func:`docking_parameters`) and the command that reads it."""
    name = F.col("name")
    text = _filled(template, {"ligand": F.col("ligand_file"), "prefix": _path(folder, name, ""), **files})
    given = _path(folder, name, ".in")
    return ligands.filter("name is not null and ligand_file is not null").select(
        "name", _path(folder, name, suffix).alias("output"), given.alias("input_path"), text.alias("input_text"), F.array(F.lit(program), F.lit("-i"), given, F.lit("-o"), _path(folder, name, ".out")).alias("command")
    )


def cnn_docking_jobs(inputs: DataFrame, folder: str, program: str = "gnina", settings: Mapping[str, object] | None = None, score_only: bool = False, autobox: str | None = None) -> DataFrame:
    """A job per (name, protein_pdb, ligand_file, binding_box): center_x ... size_z of the box, or a box around the file ``autobox``."""
    values = {"exhaustiveness": 32, "num_modes": 100, "cnn_scoring": "rescore", "seed": 0} | dict(settings or {})
    if score_only:
        values = {k: v for k, v in values.items() if k not in ("exhaustiveness", "num_modes")}
    out = _path(folder, F.col("name"), "_gnina.sdf")
    arguments: list[Column] = [F.lit(program), F.lit("--receptor"), F.col("protein_pdb"), F.lit("--ligand"), F.col("ligand_file"), F.lit("--out"), out]
    if autobox:
        arguments += [F.lit("--autobox_ligand"), F.lit(autobox), F.lit("--autobox_add"), F.lit(str(values.pop("autobox_add", 6.0)))]
    else:
        for c, digits in [(f"center_{a}", 3) for a in "xyz"] + [(f"size_{a}", 1) for a in "xyz"]:
            arguments += [F.lit(f"--{c}"), F.format_string(f"%.{digits}f", F.col("binding_box")[c].cast("double"))]
    arguments += [F.lit("--score_only")] if score_only else []
    for k, v in values.items():
        arguments += [F.lit(f"--{k}"), *([] if v is True else [F.lit(str(v))])] if v not in (None, False) else []
    return inputs.filter("name is not null and ligand_file is not null").select("name", out.alias("output"), F.lit(None).cast("string").alias("input_path"), F.lit(None).cast("string").alias("input_text"), F.array(*arguments).alias("command"))


def charge_jobs(ligands: DataFrame, folder: str, program: str = "antechamber", method: str = "bcc", atom_type: str = "sybyl") -> DataFrame:
    """A job per (name, ligand_file, formal_charge) that makes a mol2 with partial charges; a null charge is 0."""
    out = _path(folder, F.col("name"), ".mol2")
    kind = F.lower(F.regexp_extract("ligand_file", r"\.([^.]+)$", 1))
    options = [F.lit("-i"), F.col("ligand_file"), F.lit("-fi"), kind, F.lit("-o"), out, F.lit("-fo"), F.lit("mol2"), F.lit("-c"), F.lit(method), F.lit("-at"), F.lit(atom_type), F.lit("-nc"), F.coalesce(F.col("formal_charge"), F.lit(0)).cast("int").cast("string"), F.lit("-pf"), F.lit("y"), F.lit("-dr"), F.lit("n")]
    return _plain(ligands, out, [F.lit(program), *options])


def fallback_charge_jobs(ligands: DataFrame, folder: str, program: str = "obabel") -> DataFrame:
    """The same by simple charges, for ligands whose first job failed."""
    out = _path(folder, F.col("name"), ".mol2")
    return _plain(ligands, out, [F.lit(program), F.col("ligand_file"), F.lit("-O"), out, F.lit("--partialcharge"), F.lit("gasteiger")])


def protonation_jobs(molecules: DataFrame, folder: str, levels: list[float], program: str = "obabel") -> DataFrame:
    """A job per molecule (name, smiles) and pH: a 3-D structure in the folder ``pH63`` of pH 6.3."""
    rows = molecules.filter("name is not null and smiles is not null").withColumn("ph", F.explode(F.array(*[F.lit(float(x)) for x in levels])))
    out = F.concat(F.lit(folder.rstrip("/") + "/pH"), F.round(F.col("ph") * 10).cast("int").cast("string"), F.lit("/"), F.regexp_replace("name", r"[^A-Za-z0-9._-]", "_"), F.lit(".sdf"))
    command = [F.lit(program), F.concat(F.lit("-:"), F.col("smiles")), F.lit("-O"), out, F.lit("--gen3d"), F.lit("-p"), F.format_string("%.1f", "ph")]
    return rows.select("name", out.alias("output"), F.lit(None).cast("string").alias("input_path"), F.lit(None).cast("string").alias("input_text"), F.array(*command).alias("command"), "ph")


def receptor_job(files: DataFrame, folder: str, ph: float, force_field: str = "AMBER", program: str = "pdb2pqr30") -> DataFrame:
    """A job per receptor (name, path): hydrogens and charges at a pH, titration states by pKa."""
    out = _path(folder, F.col("name"), ".pqr")
    command = [F.lit(program), F.lit("--ff"), F.lit(force_field), F.lit("--titration-state-method"), F.lit("propka"), F.lit("--with-ph"), F.lit(str(ph)), F.lit("--keep-chain"), F.lit("--pdb-output"), _path(folder, F.col("name"), "_H.pdb"), F.col("path"), out]
    return _plain(files.withColumn("ligand_file", F.col("path")), out, command)


def grid_job(receptors: DataFrame, folder: str, definitions: str, spheres: str = "selected_spheres.sph", program: str = "grid", settings: Mapping[str, object] | None = None) -> DataFrame:
    """A job per prepared receptor (name, path): the energy grids around the selected spheres."""
    given = _path(folder, F.col("name"), "_grid.in")
    text = _filled(grid_parameters("{receptor}", "{box}", definitions, "{prefix}", settings), {"receptor": F.col("path"), "box": _path(folder, F.col("name"), "_box.pdb"), "prefix": _path(folder, F.col("name"), "")})
    return receptors.select("name", _path(folder, F.col("name"), ".nrg").alias("output"), given.alias("input_path"), text.alias("input_text"), F.array(F.lit(program), F.lit("-i"), given, F.lit("-o"), _path(folder, F.col("name"), "_grid.out")).alias("command"))


def _plain(rows: DataFrame, out: Column, command: list[Column]) -> DataFrame:
    empty = F.lit(None).cast("string")
    return rows.filter("name is not null and ligand_file is not null").select("name", out.alias("output"), empty.alias("input_path"), empty.alias("input_text"), F.array(*command).alias("command"))


def run_prepared(jobs: DataFrame, timeout: float = 1800.0, dry_run: bool = False, tasks: int | None = None) -> DataFrame:
    """The status table of prepared jobs; each job's input file is written before its command starts."""

    def command(row: dict) -> list[str]:
        for path in filter(None, (row.get("input_path"), row.get("output"))):
            os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        if row.get("input_path"):
            with open(row["input_path"], "w", encoding="utf-8") as f:
                f.write(row["input_text"])
        return [str(x) for x in row["command"]]

    return run_jobs(jobs, command, timeout, dry_run, tasks)


def failed_only(rows: DataFrame, status: DataFrame) -> DataFrame:
    """Rows whose job didn't end well: those for a fallback or another attempt."""
    return rows.join(status.filter("status = 'OK'").select("name"), "name", "left_anti")
