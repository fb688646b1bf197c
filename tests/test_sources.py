import json

import pytest
from pyspark.sql import functions as F

from poselake import config
from poselake.operators import external
from poselake.operators.fragmentation import fragment_molecules, rigid_fragments
from poselake.sinks import files
from poselake.sources import mol2, molecules, pdb, reports, sdf

POSE = """##########                                Name:                 {name}
##########                          Grid_Score:          {score}
##########                     Grid_vdw_energy:          -46.697788
##########                              Custom:          abc

@<TRIPOS>MOLECULE
{name}
 3 2 1 0 0
SMALL
GASTEIGER

@<TRIPOS>ATOM
      1 C1   1.0000 2.0000 3.0000 C.3   1 LIG 0.1000
      2 O1   1.5000 2.0000 3.0000 O.2   1 LIG -0.2000
      3 H1   0.5000 2.0000 3.0000 H     1 LIG 0.0500
      bad line
@<TRIPOS>BOND
     1 1 2 1
     2 1 3 1

"""
STDOUT = """# comment
mode |   affinity | CNN score | CNN affinity
-----+------------+-----------+--------------
   1       -8.320      0.847       -7.920
   2       -7.952      0.721       -7.450

   x y z
   3       -7.128 1.0     0.612       -6.880
"""


def test_scored_mol2(spark, tmp_path):
    (tmp_path / "a.mol2").write_text("".join(POSE.format(name="MOL", score=s) for s in ("-54.776524", "-50", "n/a")))
    (tmp_path / "empty.mol2").write_text("")
    poses = mol2.scored_poses(spark, str(tmp_path), "*.mol2")
    got = mol2.pose_table(poses).orderBy("pose_index").collect()
    assert [(r.name, r.pose_index, r.n_atoms, r.grid_score) for r in got] == [("MOL", 0, 3, -54.776524), ("MOL", 1, 3, -50.0), ("MOL", 2, 3, None)]
    assert got[0].extra == {"Custom": "abc"} and got[0].grid_vdw_energy == -46.697788
    heavy = mol2.heavy_atoms(poses).filter("pose_index = 1").orderBy("atom_index").collect()
    assert [(r.element, r.x) for r in heavy] == [("C", 1.0), ("O", 1.5)]
    assert mol2.pose_atoms(poses, 2).count() == 3
    assert files.best_pose_blocks(poses).first().block.count("-54.776524") == 1
    check = mol2.validation(spark, str(tmp_path / "a.mol2"), 2).first()
    assert check.valid and check.has_charges and check.molecule_type == "SMALL" and not check.has_substructure


def test_plain_mol2_has_one_row_per_molecule(spark, tmp_path):
    text = POSE.format(name="A", score="-1").split("\n\n", 1)[1]
    (tmp_path / "m.mol2").write_text(text + text.replace("\nA\n", "\nB\n"))
    assert [r.name for r in mol2.molecules(spark, str(tmp_path)).orderBy("name").collect()] == ["A", "B"]


def _sdf(name, n, extra=""):
    atoms = "".join(f"{i:10.4f}{0:10.4f}{0:10.4f} {'C' if i < n - 1 else 'H'}   0  0\n" for i in range(n))
    return f"{name}\n  prog\n\n{n:3d}  0  0  0  0  0  0  0  0  0999 V2000\n{atoms}M  END\n{extra}\n$$$$\n"


def test_docked_sdf(spark, tmp_path):
    terms = "> <atomic_interaction_terms>\natomid el pos gauss\n <0,0,0> 1 2 3 4 5\n <1,0,0> 6 7 8 9 10\n <2,0,0> 1 1 1 1 1\n\n"
    one = _sdf("x", 3, "> <minimizedAffinity>\n-8.5\n\n> <CNNscore>\n-0.25\n\n> <Note>\nhello\n\n" + terms)
    (tmp_path / "LIG_gnina.sdf").write_text(one + _sdf("x", 3, "> <Other>\n1\n\n") + "\n")
    poses = sdf.docked_poses(spark, str(tmp_path), "*.sdf").orderBy("pose_index").collect()
    assert [(r.name, r.pose_index, r.elements) for r in poses] == [("LIG", 0, ["C", "C"]), ("LIG", 1, ["C", "C"])]
    assert poses[0].scores == {"vina_affinity": -8.5, "cnn_score": -0.25} and poses[1].scores == {"Other": 1.0}
    assert poses[0].atom_terms == [[1, 2, 3, 4, 5], [6, 7, 8, 9, 10]]
    got = sdf.docked_scores(spark, str(tmp_path), "*.sdf").collect()
    assert [(r.name, r.pose_index, r.vina_affinity, r.cnn_score, r.cnn_affinity) for r in got] == [("LIG", 0, -8.5, -0.25, None)]


def test_sdf_library_and_folder(spark, tmp_path):
    (tmp_path / "lib.sdf").write_text(_sdf("first word", 2, "> <rmsd>\n1.5\n\n") + _sdf("", 2))
    (tmp_path / "s.smi").write_text("# head\nCCO ethanol\n\nCC\n")
    (tmp_path / "t.csv").write_text("id,Smile\na,CCO\nb,\nc,nan\n,CN\n")
    (tmp_path / "notes.md").write_text("x")
    lib = sdf.library(spark, str(tmp_path / "lib.sdf")).orderBy("record_no").collect()
    assert lib[0].name == "first" and lib[0].rmsd == 1.5 and lib[1].name.startswith("MOL_")
    assert molecules.detect_format(str(tmp_path)) == "directory" and set(molecules.discover(str(tmp_path))) == {"sdf", "smiles", "csv"}
    got = {(r.name, r.smiles) for r in molecules.read_any(spark, str(tmp_path)).filter("source_format <> 'sdf'").collect()}
    assert {("ethanol", "CCO"), ("SMI_0003", "CC"), ("a", "CCO")} <= got and len(got) == 4
    with pytest.raises(ValueError):
        molecules.detect_format("x.pdf")
    assert "mw" in molecules.with_properties(molecules.smiles_file(spark, str(tmp_path / "s.smi"))).columns


def test_selection_below_junk(spark, tmp_path):
    (tmp_path / "sel.csv").write_text("report,,\n,,\nx,Name,y\n1,AAA,2\n3,,4\n5,BBB,6\n")
    assert sorted(r.name for r in molecules.selection(spark, str(tmp_path / "sel.csv")).collect()) == ["AAA", "BBB"]


def test_json_inputs_default_box(spark, tmp_path):
    (tmp_path / "i.json").write_text(json.dumps({"binding_box": {"x": 1.0}, "molecules": [{"name": "a", "binding_box": {"x": 2.0}}, {"name": "b", "binding_box": None}]}))
    got = {r.name: r.binding_box.x for r in molecules.docking_inputs(spark, str(tmp_path / "i.json")).collect()}
    assert got == {"a": 2.0, "b": 1.0}


def test_stdout_table(spark, tmp_path):
    (tmp_path / "o.txt").write_text(STDOUT)
    got = reports.stdout_table(spark, str(tmp_path / "o.txt")).orderBy("mode").collect()
    assert [tuple(r)[1:] for r in got] == [(1, -8.32, 0.847, -7.92), (2, -7.952, 0.721, -7.45), (3, -7.128, 0.612, -6.88)]


def test_footprints(spark, tmp_path):
    bar = "#" * 40
    body = "##  Footprint_Similarity_Score:  {s}\nresname resid vdw_ref es_ref hb_ref vdw es hb\nTRP 392 -1.0 -0.5 1 -2.0 0.25 0\nASP 7 0 0 0 -0.1 -0.2 2\nshort row\n\n"
    (tmp_path / "f.txt").write_text("preamble\n" + "".join(f"{bar}\n### Molecule: M{i}\n{body.format(s=i)}" for i in (1, 2)))
    mapping = spark.createDataFrame([(392, "TRP10.B")], "seq_id int, residue_id string")
    got = reports.footprints(spark, str(tmp_path / "f.txt"), mapping).orderBy("pose_id", "residue_number").collect()
    assert [(r.name, r.pose_id, r.residue_id, r.total, r.delta_total, r.fps_score) for r in got[:2]] == [("M1", 0, "ASP7.A", -0.3, -0.3, 1.0), ("M1", 0, "TRP10.B", -1.75, -0.25, 1.0)]
    assert len(got) == 4


PDB = """REMARK x
ATOM      1  N   TRP A 392      11.000  12.000  13.000  1.00  0.00           N
ATOM      2  CA ATRP A 392      11.500  12.000  13.000  1.00  0.00           C
ATOM      3  CA BTRP A 392      11.600  12.000  13.000  1.00  0.00           C
ATOM      4  HA  TRP A 392      11.700  12.000  13.000  1.00  0.00
ATOM      5  CA  GLY B   1      90.000  90.000  90.000  1.00  0.00           C
HETATM    6  O   HOH A 500       1.000   1.000   1.000  1.00  0.00           O
HETATM    7 ZN    ZN A 501       2.000   2.000   2.000  1.00  0.00          ZN
HETATM    8  C1  LIG A 502       3.000   3.000   3.000  1.00  0.00           C
ATOM      9  CB  TRP A 392      xx.500  12.000  13.000  1.00  0.00           C
END
"""


def test_pdb(spark, tmp_path, rows):
    (tmp_path / "r.pdb").write_text(PDB)
    atoms = pdb.receptor_atoms(spark, str(tmp_path / "r.pdb"))
    assert rows(atoms, "residue_id", "atom") == [("GLY1.B", "CA"), ("TRP392.A", "CA"), ("TRP392.A", "CA"), ("TRP392.A", "N"), ("ZN501.A", "ZN")]
    lines = pdb.pdb_lines(spark, str(tmp_path / "r.pdb"))
    kept, removed = pdb.cleaned(lines, chains=("A",))
    assert rows(removed) == [("alt_loc", 1), ("chain", 1), ("hetero", 1), ("water", 1)]
    text = files.pdb_text(pdb.without_hydrogens(kept)).first().text
    assert " CA  TRP" in text and "HA" not in text and text.strip().endswith("END")
    assert rows(pdb.alpha_carbons(spark, str(tmp_path / "r.pdb")), "resname", "resid") == [("GLY", 1), ("TRP", 392)]


def test_pqr_and_pka(spark, tmp_path, rows):
    (tmp_path / "q.pqr").write_text("ATOM 1 N ALA A 5 0 0 0 0.10 1.8\nATOM 2 N ALA A 5 0 0 0 0.20 1.8\nATOM 3 CA ALA 5 0 0 0 0.30 1.8\n")
    q = pdb.pqr_charges(spark, str(tmp_path / "q.pqr"))
    assert rows(q) == [("", 5, "CA", 0.3), ("A", 5, "N", 0.2)]
    atoms = spark.createDataFrame([(1, 5, "N", 0.0), (2, 5, "CA", 0.0), (3, 6, "N", -9.0)], "ord int, res_num int, atom string, charge double")
    assert rows(pdb.injected_charges(atoms, q), "ord", "charge") == [(1, 0.2), (2, 0.3), (3, -9.0)]
    (tmp_path / "p.log").write_text("   HIS  64 A   6.50\nxx\n   ASP 9 B -1.2 more\n")
    assert rows(pdb.pka_table(spark, str(tmp_path / "p.log"))) == [("ASP", 9, "B", -1.2), ("HIS", 64, "A", 6.5)]


def test_writers_round_trip(spark, tmp_path):
    atoms = [("C1", 1.0, 2.0, 3.0, "C.3", 0.1), ("O1", 1.5, 2.0, 3.0, "O.2", None)]
    df = spark.createDataFrame([("M/1", atoms, [(1, 2, "1")])], "name string, atoms array<struct<atom_name:string,x:double,y:double,z:double,atom_type:string,charge:double>>, bonds array<struct<a:int,b:int,kind:string>>")
    df = df.withColumn("block", files.mol2_block(F.col("name"), F.col("atoms"), F.col("bonds")))
    out = files.write_blocks(df, str(tmp_path / "o"), "name", "block", ".mol2").collect()
    assert out[0].path.endswith("M_1.mol2")
    back = mol2.scored_poses(spark, str(tmp_path / "o"), "*.mol2").first()
    assert back.name == "M/1" and [(a.x, a.element) for a in back.atoms] == [(1.0, "C"), (1.5, "O")]
    files.write_csv(df.select("name", "atoms"), str(tmp_path / "c"), 1)
    assert spark.read.csv(str(tmp_path / "c"), header=True, escape='"').first().name == "M/1"
    files.write_json(df.select("name"), str(tmp_path / "j"))
    files.write_parquet(df.select("name", F.lit(1).alias("k")), str(tmp_path / "p"), ("k",))
    assert spark.read.parquet(str(tmp_path / "p")).count() == spark.read.json(str(tmp_path / "j")).count() == 1
    assert files.nested(df.select("name", F.lit(2).alias("v")), ("name",), "rows", ("v",)).first().rows[0].v == 2
    assert "M/1" in files.text_summary(df.select("name"), "T") and "<td>M/1</td>" in files.html_table(df.select("name"), "T")


def test_inputs_and_parameters(spark):
    box = spark.createDataFrame([(1.0, 20.0)], "center_x double, size_x double")
    mols = spark.createDataFrame([("a", "a.sdf", "CC")], "name string, ligand_file string, smiles string")
    control = spark.createDataFrame([("REF", "r.mol2", None)], "name string, ligand_file string, smiles string")
    got = {r.name: json.loads(r.json) for r in files.docking_inputs(mols, "rec.pdb", box, control=control).collect()}
    assert got["REF"]["metadata"] == {"is_reference": True, "strategy": "reference_control"} and got["a"]["binding_box"]["size_x"] == 20.0 and got["a"]["ligand_format"] == "sdf"
    assert files.with_parameters("a   1\nb   2\n", {"b": True, "c": 3}).split() == ["a", "1", "b", "yes", "c", "3"]
    assert files.sphere_input("s.ms", "s.sph").splitlines()[1:3] == ["R", "X"]


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("stage:\n  top_n: 5 # x\n  rank_by: 'cnn_score'\n")
    c = config.merged(config.read_config(str(tmp_path / "c.yaml")), {"top_n": None, "padding": 4.0, "other": 1})
    assert (c.top_n, c.rank_by, c.padding, c.contact_cutoff) == (5, "cnn_score", 4.0, 4.5)
    assert config.grid_prefix("/path/to/grids", "grid.nrg") == "/path/to/grids/grid" and not config.grids_ready(str(tmp_path))
    (tmp_path / "pH63").mkdir()
    (tmp_path / "ligand.mol2").write_text("x")
    assert config.ph_folder(str(tmp_path), 6.3).name == "pH63" and config.reference_ligand(str(tmp_path)).name == "ligand.mol2" and config.ligand_file(str(tmp_path), "ligand").suffix == ".mol2"


def test_external_jobs(spark, tmp_path):
    jobs = spark.createDataFrame([(n, str(tmp_path / n)) for n in ("ok", "bad", "slow")], "name string, output string")
    script = {"ok": "echo x > {}", "bad": "echo no >&2; exit 3", "slow": "sleep 5"}
    status = external.run_jobs(jobs, lambda r: ["sh", "-c", script[r["name"]].format(r["output"])], timeout=1.0).cache()
    got = {r.name: r for r in status.collect()}
    assert {k: v.status for k, v in got.items()} == {"ok": "OK", "bad": "FAILED", "slow": "TIMEOUT"} and got["bad"].error == "no"
    one = external.status_counts(status).first()
    assert (one.n, one.n_ok, one.n_failed, one.n_timeout) == (3, 1, 1, 1)
    assert {r.status for r in external.run_jobs(jobs, lambda r: [], dry_run=True).collect()} == {"DRY_RUN"}
    assert external.formal_charge({"charge": "-1.0"}) == -1 and external.formal_charge({}) == 0


def test_fragmentation(spark):
    ring = [(i, (i + 1) % 6, False) for i in range(6)]
    got = rigid_fragments(12, [*ring, (5, 6, True), (6, 7, False), (7, 8, True), (8, 9, False), (9, 10, False), (10, 11, False)], set(range(6)))
    assert [(f["label"], f["atoms"]) for f in got] == [("ring_0", [0, 1, 2, 3, 4, 5, 6, 7]), ("linker_0", [8, 9, 10, 11])]
    assert rigid_fragments(3, [], set())[0]["label"] == "whole_0" and rigid_fragments(6, ring, set(range(6)))[0]["label"] == "rigid_0"
    df = spark.createDataFrame([("m", 3, None, None)], "name string, n_atoms int, bonds array<struct<a:int,b:int,rotatable:boolean>>, ring_atoms array<int>")
    assert fragment_molecules(df).first().label == "whole_0"
