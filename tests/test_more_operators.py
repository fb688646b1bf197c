import os
import sys

import pytest
from pyspark.sql import functions as F

from poselake.functions import classify
from poselake.operators import jobs, metadata, structures
from poselake.operators.external import run_jobs
from poselake.sinks import reports, workbook
from poselake.sources import mol2, molecules, sdf, text


def test_metadata_joins(spark, rows):
    left = spark.createDataFrame([("a", 1.0, None), ("b", None, "x"), (None, 2.0, None)], "name string, score double, note string")
    more = spark.createDataFrame([("a", 5.0, "n"), ("a", 4.0, "m"), ("z", 1.0, "q")], "name string, score double, kind string")
    assert rows(metadata.with_metadata(left, more), "name", "score", "kind") == [("a", 1.0, "m"), ("b", None, None), (None, 2.0, None)]
    assert metadata.with_metadata(left, more.select("name")).columns == left.columns
    numbered = spark.createDataFrame([(1,), (2,)], "name int")
    assert rows(metadata.with_metadata(numbered, spark.createDataFrame([("1", "k")], "id string, kind string"), metadata_key="id")) == [(1, "k"), (2, None)]
    filled = metadata.left_filled(left, more.select("name", F.col("score").alias("other"), "kind").filter("kind <> 'm'"), ["name"])
    assert rows(filled, "name", "score", "other", "kind") == [("a", 1.0, 5.0, "n"), ("b", 0.0, 0.0, None), (None, 2.0, 0.0, None)]
    nested = spark.createDataFrame([("a", (1, ("s",)))], "name string, metadata struct<n: int, deep: struct<t: string>>")
    assert rows(metadata.with_nested_metadata(left, nested), "name", "n", "deep_t") == [("a", 1, "s"), ("b", None, None), (None, None, None)]
    assert metadata.flattened(nested).columns == ["name", "metadata.n", "metadata.deep.t"]
    assert metadata.named_only(left, ["b"]).count() == 1 and metadata.named_only(left, None).count() == 3 and metadata.named_only(left, more).count() == 1


def test_lookups(spark, rows):
    spots = spark.createDataFrame([("a", 0, 0), ("a", 0, 1), ("b", 0, 0)], "name string, fragment_id int, cluster int")
    found = spark.createDataFrame([("a", "second", 0, 1, 9.0), ("a", "first", 0, 0, -1.5), ("b", "second", 0, 0, 2.0)], "name string, score_key string, fragment_id int, cluster int, coefficient double")
    assert rows(metadata.with_contributions(spots, found, ["first", "second"]), "name", "cluster", "score_contribution") == [("a", 0, -1.5), ("a", 1, 0.0), ("b", 0, 2.0)]
    kinds = spark.createDataFrame([("m", "GLY1.A", "hbond", 2.0, None), ("m", "GLY1.A", "hbond", 3.0, None), ("m", "GLY1.A", "ionic", 3.0, None)], metadata.INTERACTIONS)
    res = spark.createDataFrame([("GLY1.A",), ("SER2.A",)], "residue_id string")
    assert rows(metadata.with_interactions(res, kinds)) == [("GLY1.A", ["hbond", "ionic"]), ("SER2.A", [])]


def test_structures(spark, rows):
    labels = spark.createDataFrame([("m", f, p, c) for f in (0, 1) for p, c in enumerate([0, 0, 0, 1, 1, -1])], "name string, fragment_id int, pose_index int, cluster int")
    rmsd = lambda a, b: abs(a - b) + 0.5 * (a == 0)
    pairs = spark.createDataFrame([("m", f, a, b, float(rmsd(a, b))) for f in (0, 1) for a in range(6) for b in range(a + 1, 6)], "name string, fragment_id int, pose_a int, pose_b int, rmsd double")
    dominant = spark.createDataFrame([("m", f, 6, 0) for f in (0, 1)], "name string, fragment_id int, n_poses int, dominant_cluster int")
    scores = spark.createDataFrame([("m", p, "vina", v) for p, v in enumerate([-5.0, -7.0, -7.0, -9.0, -8.0, -20.0])], "name string, pose_index int, score_key string, value double")
    got = {r.label: r.pose_index for r in structures.export_selection(pairs, labels, dominant, scores).collect()}
    assert got == {"frag0_cl0": 1, "frag0_cl1": 3, "frag1_cl0": 1, "frag1_cl1": 3, "full_consensus": 1, "sweet1_vina": 3, "sweet2_vina": 1}
    assert rows(structures.dominant_rmsd(pairs, labels, dominant), "fragment_id", "dominant_rmsd") == [(0, pytest.approx((1.5 + 2.5 + 1) / 3)), (1, pytest.approx((1.5 + 2.5 + 1) / 3))]
    atoms = spark.createDataFrame([("m", p, i, float(p), float(i), 0.0) for p in range(6) for i in range(2)], "name string, pose_index int, atom_index int, x double, y double, z double")
    members = spark.createDataFrame([("m", f, i) for f in (0, 1) for i in range(2)], "name string, fragment_id int, atom_index int")
    assert rows(structures.cluster_centroids(atoms, members, pairs, labels, dominant), "fragment_id", "cluster", "x", "y", "cluster_size") == [(f, 0, 1.0, 0.5, 3) for f in (0, 1)]
    assert structures.cluster_centroids(atoms, members, pairs, labels, dominant, every=True, least=0.3).count() == 4
    tags = structures.named_by_hotspot(structures.export_selection(pairs, labels, dominant, scores), spark.createDataFrame([("m", 0, 0, 7)], "name string, fragment_id int, cluster int, hotspot int"))
    assert "frag0_cl0_H7" in {r.label for r in tags.collect()}
    assert structures.export_selection(pairs.limit(0), labels.limit(0), dominant, scores).count() == 0


def test_badges(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    a = lambda e, c: one(classify.fragment_assessment(F.lit(e), F.lit(c)))
    assert [a(-3.5, 0.7), a(-2.5, 0.8), a(-4.0, 0.4), a(-1.0, 0.2), a(-1.0, 0.9), a(-1.0, 0.5)] == ["Anchor", "Reliable", "Potent but variable", "Unreliable", "Stable, weak", "Moderate"]
    b = lambda e, c: one(classify.residue_badge(F.lit(e), F.lit(c)))
    assert [b(-6.0, 0.9), b(-3.0, 0.8), b(-6.0, 0.4), b(0.0, 0.1), b(0.0, 0.5)] == ["Anchor", "Reliable", "Strong but variable", "Unreliable", None]
    assert one(classify.share_bin(F.lit(0.6))) == "medium" and one(classify.stamp(F.timestamp_seconds(F.lit(0)))) == "1970-01-01 00:00:00"


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a & <b>", 1, -1.5, True, None), ("x" * 100, 12, float("nan"), False, "é\x01")], "name string, rank int, score double, is_reference boolean, note string").coalesce(1)
    path = str(tmp_path / "w.xlsx")
    workbook.write_workbook(path, {"one": df, "two": df.select("name")}, workbook.ranking_style())
    assert workbook.read_workbook(path) == [["name", "rank", "score", "is_reference", "note"], ["a & <b>", "1", "-1.5", "1", None], ["x" * 100, "12", "nan", "0", "é"]]
    assert workbook.read_workbook(path, 2)[1] == ["a & <b>"]
    with pytest.raises(ValueError, match="1 rows"):
        workbook.write_workbook(path, {"one": df}, most=1)
    listed = spark.createDataFrame([("junk", None), ("Name", "SMILES"), ("m1", "CC"), ("m2", None)], "a string, b string").coalesce(1)
    workbook.write_workbook(path, {"s": listed})
    assert [r.name for r in molecules.selection(spark, path).collect()] == ["m1", "m2"]
    plain = spark.createDataFrame([("m1", "CC"), (None, "CCC")], "Name string, SMILES string").coalesce(1)
    workbook.write_workbook(path, {"s": plain})
    assert [(r.name, r.smiles) for r in molecules.tabular(spark, path).collect()] == [("m1", "CC"), ("MOL_0001", "CCC")]


def test_reports(spark):
    composite = spark.createDataFrame([("a<b", 1, -3.0), ("c", 2, None)], "name string, rank int, composite_score double")
    residues = spark.createDataFrame([("GLY1.A", -2.0, 0.9)], "residue_id string, mean_total double, frac_molecules double")
    spots = spark.createDataFrame([(0, 3, 1.0)], "number int, n_molecules int, radius double")
    lists = spark.createDataFrame([("a", 2, 1)], "name string, n_lists int, consensus_rank int")
    overlap = spark.createDataFrame([("x", "y", 1)], "list_a string, list_b string, n int")
    pages = [reports.grid_engine_report(composite, residues, lists, stamp="now"), reports.cnn_engine_report(composite, spots, residues), reports.comparison_report(lists, overlap), reports.footprint_report(residues, residues.limit(0))]
    assert all(p.startswith("<!doctype html>") and p.endswith("</html>") and "<b>a" not in p for p in pages)
    assert "a&lt;b" in pages[0] and "<svg" in pages[1] and "no rows" in pages[3]
    commands, scene = reports.hotspot_scene([(0, 1.0, 2.0, 3.0, 0.5)], "rec.pdb")
    assert "open rec.pdb" in commands and ".sphere 1.000 2.000 3.000 0.50" in scene


def test_prepared_jobs(spark, tmp_path):
    script = tmp_path / "tool.py"
    script.write_text("import sys\nopen(sys.argv[4].replace('.out', '_scored.mol2'), 'w').write(open(sys.argv[2]).read())\n")
    tool = tmp_path / "tool"
    tool.write_text(f"#!/bin/sh\nexec {sys.executable} {script} \"$@\"\n")
    os.chmod(tool, 0o755)
    ligands = spark.createDataFrame([("a b", "l.mol2", 1, "CC"), (None, "x.mol2", 0, None)], "name string, ligand_file string, formal_charge int, smiles string")
    template = jobs.docking_parameters(solvent=True, settings={"max_orientations": 7, "bump_filter": None})
    rows = jobs.docking_jobs(ligands, str(tmp_path / "out"), template, {"spheres": "s.sph", "grid": "g", "receptor": "r.mol2"}, program=str(tool))
    assert [r.status for r in jobs.run_prepared(rows, dry_run=True).collect()] == ["DRY_RUN"]
    status = jobs.run_prepared(rows)
    got = [(r.status, open(r.output).read()) for r in status.collect()]
    assert [g[0] for g in got] == ["OK"] and "l.mol2" in got[0][1] and "bump_filter" not in got[0][1] and any(line.split() == ["max_orientations", "7"] for line in got[0][1].splitlines())
    assert jobs.failed_only(ligands, status).count() == 1
    charge = jobs.charge_jobs(ligands, "o").first()
    assert charge.command[charge.command.index("-nc") + 1] == "1" and charge.output == "o/a_b.mol2"
    assert jobs.fallback_charge_jobs(ligands, "o").first().command[0] == "obabel"
    assert {r.output for r in jobs.protonation_jobs(ligands, "o", [6.3, 7.4]).collect()} == {"o/pH63/a_b.sdf", "o/pH74/a_b.sdf"}
    files = spark.createDataFrame([("r", "r.pdb")], "name string, path string")
    assert "--with-ph" in jobs.receptor_job(files, "o", 7.4).first().command and "grid_spacing" in jobs.grid_job(files, "o", "vdw.defn").first().input_text
    assert jobs.box_input("s", "b") == "Y\n8.0\ns\n1\nb\n" and "footprint_similarity_score_primary" in jobs.docking_parameters(footprint=True)
    boxed = spark.createDataFrame([("a", "p.pdb", "a.sdf", (1.0, 2.0, 3.0, 10.0, 11.0, 12.0))], "name string, protein_pdb string, ligand_file string, binding_box struct<center_x: double, center_y: double, center_z: double, size_x: double, size_y: double, size_z: double>")
    assert "--score_only" in jobs.cnn_docking_jobs(boxed, "o", score_only=True).first().command and "--autobox_ligand" in jobs.cnn_docking_jobs(boxed, "o", autobox="l.sdf").first().command
    late = run_jobs(spark.createDataFrame([("t", "/nowhere")], "name string, output string"), lambda row: ["sleep", "5"], timeout=0.2).first()
    assert late.status == "TIMEOUT"


def test_large_files_are_split_and_numbered(spark, tmp_path):
    """Files in several splits: record numbers run on, and nothing is lost or doubled where a split ends."""
    record = lambda i: f"mol{i}\n\n\n  1  0  0  0  0  0  0  0  0  0999 V2000\n    {i % 10}.0000    0.0000    0.0000 C   0  0\nM  END\n> <minimizedAffinity>\n-{i}.5\n\n$$$$\n"
    (tmp_path / "m_gnina.sdf").write_text("".join(record(i) for i in range(400)))
    (tmp_path / "s.smi").write_text("".join("# c\n" if i % 7 == 0 else f"C{i}\n" for i in range(3000)))
    (tmp_path / "t.csv").write_text("SMILES\n" + "".join(f"C{i}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    try:
        scan = text.records(spark, str(tmp_path / "m_gnina.sdf"), "$$$$")
        assert spark.read.text(str(tmp_path / "m_gnina.sdf")).rdd.getNumPartitions() >= 3
        assert sorted(r.record_no for r in scan.collect()) == list(range(401))  # the line end behind the last record is one
        poses = sdf.docked_poses(spark, str(tmp_path / "m_gnina.sdf")).collect()
        assert sorted((r.pose_index, r.scores["vina_affinity"]) for r in poses) == [(i, -i - 0.5) for i in range(400)] and {r.name for r in poses} == {"m"}
        assert {r.name for r in molecules.smiles_file(spark, str(tmp_path / "s.smi")).collect()} == {f"SMI_{i:04d}" for i in range(3000) if i % 7}
        assert sorted((r.name, r.smiles) for r in molecules.tabular(spark, str(tmp_path / "t.csv")).collect()) == sorted((f"MOL_{i:04d}", f"C{i}") for i in range(3000))
        assert {r.name for r in sdf.library(spark, str(tmp_path / "m_gnina.sdf")).collect()} == {f"mol{i}" for i in range(400)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_mol2_repairs(spark, tmp_path):
    body = "@<TRIPOS>MOLECULE\nm\n 2 1 0 0 0\nSMALL\nUSER_CHARGES\n\n@<TRIPOS>ATOM\n1 C1 0.0 0.0 0.0 C.3 1 LIG 0.5\n2 O1 1.0 0.0 0.0 O.2 1 LIG -0.5\n@<TRIPOS>BOND\n1 1 2 2\n"
    (tmp_path / "ok.mol2").write_text(body)
    (tmp_path / "bad.mol2").write_text(body.replace("0.5", "0.0").replace("C.3", "C").replace("O.2", "O"))
    got = {os.path.basename(r.path): r.valid for r in mol2.ligand_validation(spark, str(tmp_path / "*.mol2")).collect()}
    assert got == {"ok.mol2": True, "bad.mol2": False}
    a = spark.createDataFrame([("m", ["C", "O"]), ("n", ["C"])], "name string, elements array<string>")
    assert {r.name: r.same for r in mol2.same_elements(a, a.withColumn("elements", F.array(F.lit("C"), F.lit("O")))).collect()} == {"m": True, "n": False}
    atoms = spark.createDataFrame([("p", 3, 2, "SER", "A"), ("p", 1, 1, "GLY", "A"), ("p", 2, 1, "GLY", "A")], "path string, ord int, res_num int, res_name string, chain string")
    section = mol2.synthesized_substructures(atoms).first().text
    assert [line.split()[:3] for line in section.splitlines()[1:]] == [["1", "GLY1", "1"], ["2", "SER2", "3"]]
    whole = spark.range(1).select(mol2.with_substructures(F.lit(body + "@<TRIPOS>SUBSTRUCTURE\nold\n"), F.lit(section))).first()[0]
    assert whole.count("SUBSTRUCTURE") == 1 and "old" not in whole and whole.startswith(body.rstrip("\n"))
