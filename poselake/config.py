"""Parameters of a run: defaults, then the campaign's, then the module's, then what is given on the call."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Config:
    """Defaults of every module, lengths in Å, energies in kcal/mol."""

    score_key: str = "grid_score"
    top_n: int = 0
    top_n_lists: int = 20
    top_n_engine: int = 10
    rank_by: str = "vina_affinity"
    energy_cutoff: float = -0.5
    favourable: float = 0.0
    consistency_threshold: float = 0.5
    pharmacophore_threshold: float = 0.8
    contact_cutoff: float = 4.5
    site_cutoff: float = 5.0
    trim_radius: float = 25.0
    padding: float = 6.0
    pose_eps: float = 3.0
    pose_min_samples: int = 5
    hotspot_eps: float = 2.0
    hotspot_min_molecules: int = 3
    min_dominant_fraction: float = 0.15
    min_fragment_atoms: int = 4
    clusters_per_fragment: int = 3
    n_sweet_spots: int = 10
    engine: str = "both"
    ph: float | None = None
    ph_levels: tuple[float, ...] = (7.4,)
    molecule_names: tuple[str, ...] = ()
    every_cluster: bool = False
    execute: bool = False
    jobs_folder: str = "jobs"
    receptor_file: str = "receptor.pdb"
    spheres_file: str = "selected_spheres.sph"
    grid_prefix: str = "grid"
    definitions: str = "vdw.defn"
    timeout: float = 1800.0


def merged(*levels: Mapping[str, object] | None) -> Config:
    """Later levels win; nulls and unknown names count as not given."""
    known = {f.name for f in fields(Config)}
    values = {k: v for level in levels if level for k, v in level.items() if k in known and v is not None}
    return replace(Config(), **values)


def read_config(path: str) -> dict:
    """Flat values of a YAML file (nested sections are flattened by their last key), by PyYAML where installed, else plain ``key: value`` lines."""
    text = Path(path).read_text()
    try:
        import yaml

        tree = yaml.safe_load(text) or {}
    except ImportError:
        tree = {}
        for line in text.splitlines():
            key, colon, value = line.split("#", 1)[0].strip().partition(":")
            if colon and value.strip():
                tree[key.strip()] = _typed(value.strip().strip("\"'"))
    out: dict = {}

    def walk(node: Mapping) -> None:
        for k, v in node.items():
            walk(v) if isinstance(v, Mapping) else out.__setitem__(k, v)

    walk(tree)
    return out


def _typed(text: str) -> object:
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return {"true": True, "yes": True, "false": False, "no": False, "null": None, "~": None}.get(text.lower(), text)


def ph_folder(root: str, ph: float) -> Path | None:
    """Folder ``pH63`` of pH 6.3, if there is one."""
    found = Path(root) / f"pH{round(ph * 10)}"
    return found if found.is_dir() else None


def reference_ligand(folder: str, named: str | None = None, stems: tuple[str, ...] = ("reference", "ligand", "native")) -> Path | None:
    """The named file if it exists, else the first by ``stems`` and suffix."""
    if named and Path(named).is_file():
        return Path(named)
    for stem in stems:
        for p in sorted(Path(folder).glob(f"{stem}.*")):
            if p.suffix.lower() in (".mol2", ".sdf", ".pdb"):
                return p
    return None


def ligand_file(folder: str, name: str, prefer: str = "auto") -> Path | None:
    """Structure of a molecule: ``sdf``, ``mol2`` or, with ``auto``, the first of these there is."""
    for suffix in ("sdf", "mol2") if prefer == "auto" else (prefer,):
        p = Path(folder) / f"{name}.{suffix}"
        if p.is_file() and p.stat().st_size:
            return p
    return None


def grid_prefix(folder: str, energy_grid: str = "grid.nrg") -> str:
    """Path of the grids without suffix."""
    return str(Path(folder) / Path(energy_grid).stem)


def grids_ready(folder: str, energy_grid: str = "grid.nrg", bump_grid: str = "grid.bmp", spheres: str | None = None) -> bool:
    """Whether all grid files are there and none is empty."""
    wanted = [energy_grid, bump_grid, *([spheres] if spheres else [])]
    return all((Path(folder) / f).is_file() and (Path(folder) / f).stat().st_size > 0 for f in wanted)
