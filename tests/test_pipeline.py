import random

import pytest

from poselake.config import Config
from poselake.plans.pipeline import STAGES, Campaign, run


def _tables(spark):
    poses = spark.createDataFrame([("a", 0, -9.0, -8.0, -1.0), ("a", 1, -7.0, -5.0, -1.0), ("b", 0, -5.0, -1.0, -4.0)], "name string, pose_index int, grid_score double, grid_vdw_energy double, grid_es_energy double")
    results = spark.createDataFrame([("a", True, -8.0, 0.5, -3.0), ("c", True, -9.0, 0.7, -4.0)], "name string, success boolean, vina_affinity double, cnn_score double, cnn_affinity double")
    fragments = spark.createDataFrame([("a", "ring_0", 0.9, -2.0), ("c", "ring_0", 0.5, -1.0)], "name string, fragment_label string, dominant_fraction double, weight double")
    return {"poses": poses, "results": results, "fragments": fragments}


def _whole(spark):
    """A small campaign: two molecules of eight atoms in two rigid halves, twelve poses in two places."""
    rnd = random.Random(1)
    molecules = spark.createDataFrame([("a", "CC", 0, "a.sdf", 0), ("b", "CCO", 1, "b.sdf", 1), ("c", "CC", 2, "c.sdf", None)], "name string, smiles string, ordinal long, ligand_file string, formal_charge int")
    bonds = spark.createDataFrame([(n, 8, [(i, i + 1, i == 3) for i in range(7)], [0, 1, 2, 3]) for n in "ab"], "name string, n_atoms int, bonds array<struct<a: int, b: int, rotatable: boolean>>, ring_atoms array<int>")
    atoms = [(n, p, i, "C", 1.5 * i + (8.0 if p % 3 == 0 else 0.0) + rnd.uniform(-0.1, 0.1), rnd.uniform(-0.1, 0.1), 0.0) for n in "ab" for p in range(12) for i in range(8)]
    pose_atoms = spark.createDataFrame(atoms, "name string, pose_index int, atom_index int, atom string, x double, y double, z double")
    scores = [(n, p, "vina_affinity", -8.0 - (p % 3 == 0) - 0.01 * p) for n in "ab" for p in range(12)]
    coords = [(n, p, s, [[x, y, z] for m, q, _, _, x, y, z in atoms if (m, q) == (n, p)]) for n, p, _, s in scores]
    residues = [("GLY1.A", "CA", 1, 0.0, 2.0, 0.0), ("SER2.A", "CA", 2, 8.0, 3.0, 0.0), ("TRP3.A", "CA", 3, 90.0, 0.0, 0.0)]
    footprint = [(n, p, r, -1.0 - p, -0.2, -1.2 - p, -0.5, -0.1, -0.6) for n in "ab" for p in range(2) for r in ("GLY1.A", "SER2.A")]
    return {
        "molecules": molecules, "bonds": bonds, "pose_atoms": pose_atoms, "receptor_files": spark.createDataFrame([("rec", "rec.pdb")], "name string, path string"),
        "pose_scores": spark.createDataFrame(scores, "name string, pose_index int, score_key string, value double"), "pose_coords": spark.createDataFrame(coords, "name string, pose_index int, score double, coords array<array<double>>"),
        "receptor": spark.createDataFrame(residues, "residue_id string, atom string, ord int, x double, y double, z double"), "reference_atoms": spark.createDataFrame([(0.0, 0.0, 0.0), (3.0, 1.0, 0.0)], "x double, y double, z double"),
        "footprint": spark.createDataFrame(footprint, "name string, pose_id int, residue_id string, vdw double, es double, total double, ref_vdw double, ref_es double, ref_total double"),
        "zones": spark.createDataFrame([("GLY1.A", "hinge"), ("SER2.A", None)], "residue_id string, zone_label string"),
        "poses": spark.createDataFrame([(n, p, s, s + 1, -1.0) for n, p, _, s in scores], "name string, pose_index int, grid_score double, grid_vdw_energy double, grid_es_energy double"),
        "results": spark.createDataFrame([(n, True, -8.0, 0.5, -3.0) for n in "ab"], "name string, success boolean, vina_affinity double, cnn_score double, cnn_affinity double"),
    }


def test_every_stage_from_first_to_last(spark, tmp_path):
    done = run(Campaign(spark, _whole(spark), Config(jobs_folder=f"{tmp_path}/jobs", hotspot_min_molecules=2), folder=f"file://{tmp_path}/kept"))
    assert {k for k in done if "." not in k} == {s[0] for s in STAGES} and len(STAGES) == 26
    assert {r.name: r.duplicate_of for r in done["00a"].collect()} == {"a": None, "b": None, "c": "a"}
    assert {r.status for k in ("00b", "00c", "01a", "01b", "01c", "01d", "02b") for r in done[k].collect()} == {"DRY_RUN"}
    job = done["01c.jobs"].filter("name = 'a'").first()
    assert "ligand_atom_file" in job.input_text and "a.sdf" in job.input_text and "{" not in job.input_text and list(job.command)[:2] == ["dock6", "-i"]
    assert {"--center_x", "1.500"} <= set(done["02b.jobs"].filter("name = 'a'").first().command)
    assert {r.residue_id for r in done["00d"].collect()} == {"GLY1.A"} | ({"SER2.A"} if done["00d"].count() == 2 else set())
    assert done["04c"].count() == 2 and {r.zone_label for r in done["04b.zones"].collect()} >= {"hinge"}
    assert {(r.name, r.label) for r in done["05a"].collect()} == {(n, x) for n in "ab" for x in ("ring_0", "linker_0")}
    assert {(r.dominant_cluster, r.dominant_size) for r in done["05b"].collect()} == {(0, 8)}  # four poses elsewhere are too few for a cluster
    assert done["05d"].count() >= 1 and done["05d.members"].count() == 4
    assert {"full_consensus", "sweet1_vina_affinity"} <= {r.label for r in done["05e"].collect()} and any("_H" in r.label for r in done["05e"].collect())
    assert done["05f"].count() >= 1 and done["05f.votes"].filter("dominant_type is null").count() == 0
    assert {r.name: r.n_lists for r in done["07a"].collect()} == {"a": 4, "b": 4}
    assert {r.name: r.exported for r in done["07b"].collect()} == {"a": True, "b": True}


def test_a_missing_input_is_named(spark):
    with pytest.raises(ValueError, match="01e .*poses"):
        run(Campaign(spark, {"results": _tables(spark)["results"]}), start="01e")
    with pytest.raises(ValueError, match="missing"):
        run(Campaign(spark, {}), missing="ignore")


def test_whole_campaign(spark):
    done = run(Campaign(spark, _tables(spark)), missing="skip")
    assert set(done) == {"01e", "02c", "04a", "04e", "05g", "07a"}  # no footprint, contacts, labels
    assert {r.name: r.n_lists for r in done["07a"].collect()} == {"a": 4, "b": 2, "c": 2}


def test_engine_and_range(spark, tmp_path):
    assert set(run(Campaign(spark, _tables(spark), Config(engine="gnina")), missing="skip")) == {"02c", "05g"}
    folder = f"file://{tmp_path}"
    assert set(run(Campaign(spark, _tables(spark), folder=folder), stop="05g", missing="skip")) == {"01e", "02c", "04a", "04e", "05g"}
    later = run(Campaign(spark, {"results": _tables(spark)["results"]}, folder=folder), start="07a", only=("07a",))
    assert later["07a"].count() == 3
