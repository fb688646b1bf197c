"""A campaign as stages: each a DataFrame over the ones before, any of them kept as Parquet."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import consensus as C
from ..operators import contacts as K
from ..operators import dbscan as D
from ..operators import export as X
from ..operators import footprint as P
from ..operators import fragments as A
from ..operators import geometry as G
from ..operators import jobs as J
from ..operators import metadata as M
from ..operators import ranking as R
from ..operators import regression as O
from ..operators import structures as S
from ..functions.classify import contact_class
from ..operators.fragmentation import fragment_molecules
from ..sinks.files import write_parquet


@dataclass
class Campaign:
    """Input tables by name, the parameters, and where stages are kept (nowhere: all stay lazy)."""

    spark: SparkSession
    tables: Mapping[str, DataFrame]
    config: Config = field(default_factory=Config)
    folder: str | None = None
    done: dict[str, DataFrame] = field(default_factory=dict)

    def get(self, name: str) -> DataFrame:
        """An input table or a stage's result."""
        return self.done[name] if name in self.done else self.tables[name]

    def has(self, *names: str) -> bool:
        return all(n in self.done or n in self.tables for n in names)


#: (code, engine, name, inputs, function); an input ``a|b`` is one of the two. Further results of a stage are named ``code.name``.
Stage = tuple[str, str, str, tuple[str, ...], Callable[[Campaign], "DataFrame | dict[str, DataFrame]"]]


def _molecules(c: Campaign) -> DataFrame:
    """The molecules of the run: those asked for, without duplicates where they have been marked."""
    known = c.get("00a").filter("duplicate_of is null") if c.has("00a") else c.get("molecules")
    return M.named_only(known, c.config.molecule_names)


def _jobs(make: Callable[[Campaign], DataFrame]) -> Callable[[Campaign], dict[str, DataFrame]]:
    """A stage of external jobs: their status, and ``jobs``, what was prepared. Without ``execute`` the status is DRY_RUN."""

    def stage(c: Campaign) -> dict[str, DataFrame]:
        jobs = make(c)
        return {"": J.run_prepared(jobs, c.config.timeout, dry_run=not c.config.execute), "jobs": jobs}

    return stage


def _docking(c: Campaign, footprint: bool = False) -> DataFrame:
    f = c.config
    places = {"spheres": f.spheres_file, "grid": f.grid_prefix, "receptor": f.receptor_file, "reference": "reference.mol2"}
    template = J.docking_parameters(footprint=footprint, definitions={"vdw_defn_file": f.definitions})
    return J.docking_jobs(_molecules(c), f.jobs_folder, template, places, suffix="_footprint_scored.txt" if footprint else "_scored.mol2")


def _site(c: Campaign) -> DataFrame:
    """Residues near the reference ligand, with the receptor's box around it."""
    ligand = c.get("reference_atoms").withColumn("atom", F.lit("L"))
    return G.residue_contacts(ligand, c.get("receptor"), (), c.config.site_cutoff)


def _inputs(c: Campaign) -> DataFrame:
    """Molecules with receptor and binding box, as the CNN docking engine takes them."""
    box = G.bounding_box(c.get("reference_atoms"), c.config.padding)
    one = box.select(F.struct(*[f"{k}_{a}" for k in ("center", "size") for a in "xyz"]).alias("binding_box"))
    return _molecules(c).select("name", "ligand_file", "smiles").crossJoin(F.broadcast(one)).withColumn("protein_pdb", F.lit(c.config.receptor_file))  # box: one row


def _footprint(c: Campaign) -> dict[str, DataFrame]:
    df = c.get("footprint")
    whole = P.residue_consensus(df, c.config.energy_cutoff)
    each = P.consistency(df, c.config.favourable)
    out = {"": whole, "summary": P.pose_summary(df, c.config.energy_cutoff), "consistency": each, "weighted": P.weighted_consistency(each, c.config.consistency_threshold), "pharmacophore": P.pharmacophore(whole, c.config.pharmacophore_threshold), "deltas": P.reference_deltas(df)}
    return out | ({"zones": P.zone_energies(whole, c.get("zones"))} if c.has("zones") else {})


def _binding_modes(c: Campaign) -> dict[str, DataFrame]:
    detail, summary = G.binding_modes(c.get("pose_coords"))
    return {"": summary, "detail": detail}


def _contacts(c: Campaign) -> DataFrame:
    """Contacts (molecule_name, residue, min_distance, ...): as given, or of the best poses by distance."""
    if c.has("contacts"):
        return c.get("contacts")
    atoms = c.get("pose_atoms")
    if c.has("01e"):
        atoms = atoms.join(c.get("01e").select("name", "pose_index"), ["name", "pose_index"], "left_semi")
    near = G.residue_contacts(atoms.withColumnRenamed("name", "molecule_name"), c.get("receptor"), ("molecule_name",), c.config.contact_cutoff)
    return near.withColumnRenamed("residue_id", "residue")


def _fragment_poses(c: Campaign) -> DataFrame:
    """(name, fragment_id, pose_index, coords) of every fragment in every pose."""
    members = c.get("05a").select("name", "fragment_id", F.explode("atom_indices").alias("atom_index"))
    placed = c.get("pose_atoms").join(members, ["name", "atom_index"])
    atoms = F.sort_array(F.collect_list(F.struct("atom_index", "x", "y", "z")))  # a molecule's atoms
    return placed.groupBy("name", "fragment_id", "pose_index").agg(F.transform(atoms, lambda a: F.array(a["x"], a["y"], a["z"])).alias("coords"))


def _clusters(c: Campaign) -> dict[str, DataFrame]:
    if c.has("labels"):
        return {"": A.dominant_clusters(c.get("labels"), c.config.min_dominant_fraction), "labels": c.get("labels")}
    poses = _fragment_poses(c)
    labels = D.cluster_poses(poses, c.config.pose_eps, c.config.pose_min_samples)
    pairs = G.pose_pairs(poses.withColumn("key", F.struct("name", "fragment_id")), by="key").select("key.name", "key.fragment_id", "pose_a", "pose_b", "rmsd")
    dominant = A.dominant_clusters(labels, c.config.min_dominant_fraction)
    return {"": S.dominant_rmsd(pairs, labels, dominant), "labels": labels, "pairs": pairs}


def _regression(c: Campaign) -> dict[str, DataFrame]:
    labels, scores = c.get("05b.labels"), c.get("pose_scores")
    fits, parts = O.score_decomposition(labels, scores)
    out = {"": parts, "fits": fits, "sweet_spots": A.sweet_spots(labels, scores, c.config.n_sweet_spots), "cluster_scores": A.cluster_scores(labels, scores)}
    if c.has("atom_terms", "05a"):
        members = c.get("05a").select("name", "fragment_id", F.explode("atom_indices").alias("atom_index"))
        out["energies"] = A.fragment_energies(c.get("atom_terms"), members, scores.groupBy("name", "pose_index").agg(F.min("value").alias("vina")))
    return out


def _hotspots(c: Campaign) -> dict[str, DataFrame]:
    members = c.get("05a").select("name", "fragment_id", F.explode("atom_indices").alias("atom_index"))
    spots = S.cluster_centroids(c.get("pose_atoms"), members, c.get("05b.pairs"), c.get("05b.labels"), c.get("05b"), c.config.every_cluster, c.config.min_dominant_fraction)
    spots = M.with_contributions(spots.join(c.get("05a").select("name", "fragment_id", "is_ring"), ["name", "fragment_id"]), c.get("05c"), ["vina_affinity", c.config.score_key])
    spots = spots.withColumn("key", F.to_json(F.struct("name", "fragment_id", "cluster")))
    found = D.dbscan_positions(spots, "key", c.config.hotspot_eps, c.config.hotspot_min_molecules).filter("cluster is not null").select("key", F.col("cluster").alias("hotspot"))
    placed = spots.join(found, "key").drop("key")
    return {"": A.hotspot_statistics(placed), "members": placed, "centroids": spots.drop("key")}


def _structures(c: Campaign) -> DataFrame:
    chosen = S.export_selection(c.get("05b.pairs"), c.get("05b.labels"), c.get("05b"), c.get("pose_scores"), c.config.clusters_per_fragment)
    numbers = c.get("05d.members").join(c.get("05d").select("hotspot", "number"), "hotspot")
    return S.named_by_hotspot(chosen, numbers.select("name", "fragment_id", "cluster", F.col("number").alias("hotspot")))


def _fragment_contacts(c: Campaign) -> dict[str, DataFrame]:
    """Contacts of fragments in their medoid poses, and what the members of each hotspot touch."""
    members = c.get("05a").select("name", "fragment_id", F.explode("atom_indices").alias("atom_index"))
    poses = c.get("05d.centroids").select("name", "fragment_id", "cluster", "pose_index")
    atoms = c.get("pose_atoms").join(members, ["name", "atom_index"]).join(poses, ["name", "fragment_id", "pose_index"]).withColumnRenamed("name", "molecule_name")
    near = G.residue_contacts(atoms, c.get("receptor"), ("molecule_name", "fragment_id", "cluster"), c.config.contact_cutoff, count="atom_pairs")
    near = near.withColumnRenamed("residue_id", "residue").withColumn("contact_type", contact_class(F.col("min_distance")))
    spots = c.get("05d.members").select(F.col("name").alias("molecule_name"), "fragment_id", "cluster", "hotspot")
    votes = K.contact_votes(K.member_contacts(spots, near, ("molecule_name", "fragment_id", "cluster")), ["hotspot"])
    return {"": K.contact_consensus(near), "contacts": near, "votes": votes}


def _fragments(c: Campaign) -> DataFrame:
    """(name, fragment_label, dominant_fraction, weight): as given, or from the stages before."""
    if c.has("fragments"):
        return c.get("fragments")
    own = c.get("05b").join(c.get("05a").select("name", "fragment_id", F.col("label").alias("fragment_label")), ["name", "fragment_id"])
    own = M.with_contributions(own.withColumnRenamed("dominant_cluster", "cluster"), c.get("05c"), ["vina_affinity", c.config.score_key])
    return own.select("name", "fragment_label", "dominant_fraction", F.col("score_contribution").alias("weight"))


def _hits(c: Campaign) -> DataFrame:
    originals = c.get("molecules").dropDuplicates(["name"])
    duplicates = c.get("00a").select("name", "duplicate_of") if c.has("00a") else originals.select("name", F.lit(None).cast("string").alias("duplicate_of"))
    return X.hit_export(c.get("07a").filter("n_lists >= 2"), originals, duplicates)


def _composite_dock6(c: Campaign) -> DataFrame:
    stats = C.pose_statistics(c.get("poses"), score=c.config.score_key)
    out = stats.withColumn("composite_score", F.col("mean_grid_score"))
    return C.ranked(out, "composite_score", "rank")


def _composite_gnina(c: Campaign) -> DataFrame:
    return A.composite_ranking(A.weighted_convergence(_fragments(c)), c.get("results"))


def _cross(c: Campaign) -> DataFrame:
    gnina = C.ranked(c.get("results").select("name", "vina_affinity"), "vina_affinity", "gnina_vina_rank")
    gnina = gnina.join(c.get("05g").select("name", F.col("rank").alias("gnina_composite_rank")), "name", "left")
    dock6 = C.ranked(C.ranked(c.get("04e").drop("rank"), "best_grid_score", "dock6_best_rank"), "mean_grid_score", "dock6_mean_rank")
    return C.consensus(C.merge_engines(gnina, dock6), c.config.top_n_lists)


#: All stages in order.
STAGES: list[Stage] = [
    ("00a", "any", "unique molecules", ("molecules",), lambda c: R.mark_duplicates(c.get("molecules"))),
    ("00b", "any", "receptor preparation", ("receptor_files",), _jobs(lambda c: J.receptor_job(c.get("receptor_files"), c.config.jobs_folder, c.config.ph or 7.4))),
    ("00c", "any", "protonation by pH", ("molecules",), _jobs(lambda c: J.protonation_jobs(_molecules(c), c.config.jobs_folder, list(c.config.ph_levels)))),
    ("00d", "any", "binding site", ("receptor", "reference_atoms"), _site),
    ("01a", "dock6", "charges of the ligands", ("molecules",), _jobs(lambda c: J.charge_jobs(_molecules(c), c.config.jobs_folder))),
    ("01b", "dock6", "energy grids", ("receptor_files",), _jobs(lambda c: J.grid_job(c.get("receptor_files"), c.config.jobs_folder, c.config.definitions, c.config.spheres_file))),
    ("01c", "dock6", "grid docking", ("molecules",), _jobs(_docking)),
    ("01d", "dock6", "energies by residue", ("molecules",), _jobs(lambda c: _docking(c, footprint=True))),
    ("01e", "dock6", "best pose per molecule", ("poses",), lambda c: R.best_rows(c.get("poses"), "name", c.config.score_key, ["pose_index"])),
    ("02a", "gnina", "inputs of the CNN docking engine", ("molecules", "reference_atoms"), _inputs),
    ("02b", "gnina", "CNN docking", ("02a",), _jobs(lambda c: J.cnn_docking_jobs(c.get("02a"), c.config.jobs_folder))),
    ("02c", "gnina", "ranks of the docking results", ("results",), lambda c: R.engine_ranks(c.get("results"), rank_by=c.config.rank_by, top_n=c.config.top_n_engine)),
    ("04a", "dock6", "score ranking", ("poses",), lambda c: R.score_ranking(c.get("poses"), score=c.config.score_key, top_n=c.config.top_n)),
    ("04b", "dock6", "energies by residue: consensus, consistency, pharmacophore, zones", ("footprint",), _footprint),
    ("04c", "dock6", "binding modes", ("pose_coords",), _binding_modes),
    ("04d", "dock6", "contact consensus", ("contacts|pose_atoms", "contacts|receptor"), lambda c: K.contact_consensus(_contacts(c))),
    ("04e", "dock6", "composite of the poses", ("poses",), _composite_dock6),
    ("05a", "gnina", "rigid fragments", ("bonds",), lambda c: fragment_molecules(c.get("bonds"), c.config.min_fragment_atoms)),
    ("05b", "any", "clusters of the fragments' poses", ("labels|05a", "labels|pose_atoms"), _clusters),
    ("05c", "any", "scores explained by clusters", ("05b.labels", "pose_scores"), _regression),
    ("05d", "gnina", "hotspots", ("05a", "05b.pairs", "05c", "pose_atoms"), _hotspots),
    ("05e", "gnina", "structures to write out", ("05b.pairs", "05d", "pose_scores"), _structures),
    ("05f", "gnina", "contacts of the fragments", ("05a", "05d.centroids", "pose_atoms", "receptor"), _fragment_contacts),
    ("05g", "gnina", "composite of the fragments", ("fragments|05c", "results"), _composite_gnina),
    ("07a", "both", "consensus of both engines", ("results", "04e", "05g"), _cross),
    ("07b", "both", "exported hits", ("07a", "molecules"), _hits),
]


def run(campaign: Campaign, start: str = "00a", stop: str = "07b", only: tuple[str, ...] = (), missing: str = "error") -> dict[str, DataFrame]:
    """Stages from ``start`` to ``stop`` (codes in their order; of these ``only``, if given) that the engine setting allows.

    A stage without its inputs is an error that names them; with ``missing="skip"`` it is left out. With a folder, each stage is written
    there and read back, and earlier stages are taken from it: a run can go on from where another ended.
    """
    if missing not in ("error", "skip"):
        raise ValueError(f"missing is 'error' or 'skip', not {missing!r}")
    engine = campaign.config.engine
    for code, needs, title, inputs, function in STAGES:
        if code > stop:
            break
        if (engine != "both" and needs not in ("any", engine)) or (only and code not in only and code >= start):
            continue
        if code < start:
            _take_kept(campaign, code)
            continue
        absent = [i for i in inputs if not any(campaign.has(x) for x in i.split("|"))]
        if absent:
            if missing == "skip":
                continue
            raise ValueError(f"stage {code} ({title}) has no input {', '.join(absent)}")
        found = function(campaign)
        for name, df in (found if isinstance(found, dict) else {"": found}).items():
            key = f"{code}.{name}" if name else code
            if campaign.folder:
                write_parquet(df, f"{campaign.folder}/{key}")
                df = campaign.spark.read.parquet(f"{campaign.folder}/{key}")
            campaign.done[key] = df
    return campaign.done


def _take_kept(campaign: Campaign, code: str) -> None:
    """Results of an earlier run of the stage."""
    if not campaign.folder:
        return
    jvm = campaign.spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(campaign.folder)
    files = folder.getFileSystem(campaign.spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.listStatus(folder) if files.exists(folder) else []:
        key = found.getPath().getName()
        if key == code or key.startswith(f"{code}."):
            campaign.done[key] = campaign.spark.read.parquet(f"{campaign.folder}/{key}")
