import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from poselake.functions import classify, residues
from poselake.operators import components, consensus, contacts, dbscan, export, footprint, fragments, geometry, latest, linking, ranking, regression
from poselake.streaming import rerank

NAN, INF = float("nan"), float("inf")


def test_latest_rows(spark, rows):
    data = [(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "x", None), (2, "y", 1), (None, "n", 1), (None, "n", 1), (3, "t", 5), (3, "u", 5)]
    df = spark.createDataFrame(data, "k int, v string, loaded_at int")
    want = [(1, "b", 3), (2, "y", 1), (3, "u", 5), (None, "n", 1), (None, "n", 1)]
    assert rows(latest.latest_rows(df, ["k"])) == want
    assert rows(latest.latest_rows(df, ["k"], near=F.floor(F.col("k") / 2))) == want
    assert latest.latest_rows(df.limit(0), ["k"]).count() == 0
    clash = df.withColumnsRenamed({"v": "__n"})
    assert rows(latest.latest_rows(clash, ["k"]).filter("k = 1"), "__n") == [("b",)]
    with pytest.raises(ValueError):
        latest.latest_rows(df.drop("loaded_at"), ["k"])


def test_finite_and_nan(spark, rows):
    df = spark.createDataFrame([(1.0,), (NAN,), (INF,), (-INF,), (None,)], "x double")
    assert rows(df.select(latest.finite("x").alias("x")).dropna()) == [(1.0,)]
    assert latest.nan_to_null(df).filter("x is null").count() == 2
    assert latest.first_present(df, ["y", "x"]) == "x" and latest.first_present(df, ["y"]) is None


@pytest.mark.parametrize(
    ("raw", "term"),
    [("GLN 123 A", "GLN123.A"), ("Leu441.b", "LEU441.B"), (" THR434.B", "THR434.B"), ("MET228:A", "MET228.A"), ("EDO-1017_A", "EDO1017.A"), ("A:GLY59", "GLY59.A"), ("B/Gly 556", "GLY556.B"), ("SER0574.B", "SER574.B"), ("ARG485.B\t", "ARG485.B"), ("zn-0012_a", "ZN12.A"), (" ", None), ("", None), (None, None), ("GLY..59", "GLY.59"), ("??", "??")],
)
def test_residue_terms(spark, raw, term):
    df = spark.createDataFrame([(raw,)], "r string")
    assert df.select(residues.residue_term(F.col("r"))).first()[0] == term


def test_contact_terms_and_parts(spark):
    df = spark.createDataFrame([("Strong-Hbond",), (" vdw ",), ("pi stacking",), ("_",), (None,), ("x_105",)], "c string")
    assert [r[0] for r in df.select(residues.contact_term(F.col("c"))).collect()] == ["strong_hbond", "vdw", "pi_stacking", None, None, "x_105"]
    got = spark.range(1).select(residues.residue_parts(F.lit("TRP392.A")).alias("p"), residues.residue_id(F.lit("GLY"), F.lit(5), F.lit("B")).alias("i")).first()
    assert tuple(got.p) == ("TRP", 392, "A") and got.i == "GLY5.B"


def test_classes(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert [one(classify.contact_class(F.lit(d))) for d in (2.4, 2.5, 3.5, 4.5)] == ["strong_hbond", "hbond", "vdw", "weak"]
    assert [one(classify.dominance(F.lit(v), F.lit(e))) for v, e in ((-5.0, -1.0), (1.0, -5.0), (-2.0, -1.0))] == ["vdW_dominant", "ES_dominant", "balanced"]
    assert one(classify.dominance(F.lit(None).cast("double"), F.lit(1.0))) == "unknown"
    assert [one(classify.stability(F.lit(x))) for x in (0.7, 0.5, 0.4)] == ["STABLE", "MODERATE", "UNSTABLE"]
    assert one(classify.dominance_share(F.lit(-0.9), F.lit(0.1))) == "vdW" and one(classify.is_fragment_kind(F.lit("ring_0"), "ring"))
    assert [one(classify.energy_bin(F.lit(x))) for x in (-1.1, -0.6, 0.0)] == ["strong", "moderate", "weak"] and one(classify.correlation_words(F.lit(-0.8))) == "strong"
    cases = [(4.0, None, "contact_only"), (4.0, -1.0, "contact_and_energy"), (4.0, 0.0, "contact_no_energy"), (9.0, -0.6, "long_range_ES"), (9.0, -0.4, "weak")]
    for d, t, want in cases:
        assert one(classify.contact_energy_class(F.lit(d), F.lit(t).cast("double"))) == want


def _poses(spark):
    data = [("one", 0, -10.0, -8.0, -1.0), ("tie", 2, -20.0, -1.0, -9.0), ("tie", 1, -20.0, -10.0, -9.0), ("tie", 0, -5.0, 0.0, 0.0), ("zero", 0, 0.0, -1.0, 1.0), ("novdw", 0, -1.0, None, -1.0), ("null", 0, None, 1.0, 1.0), (None, 0, -99.0, 1.0, 1.0)]
    return spark.createDataFrame(data, "name string, pose_index int, grid_score double, grid_vdw_energy double, grid_es_energy double")


def test_score_ranking(spark):
    got = {r.name: r for r in ranking.score_ranking(_poses(spark)).collect()}
    assert {n: r.rank for n, r in got.items()} == {"tie": 1, "one": 2, "novdw": 3, "zero": 4}
    assert got["tie"].grid_vdw_energy == -10.0 and got["tie"].n_poses == 3 and got["tie"].mean_score == -15.0 and math.isclose(got["tie"].std_score, np.std([-20, -20, -5]))
    assert got["one"].std_score == 0.0 and got["one"].dominance == "vdW_dominant" and got["zero"].vdw_fraction == 0.0 and got["novdw"].vdw_fraction is None and got["novdw"].dominance == "unknown"
    assert ranking.score_ranking(_poses(spark), top_n=2).count() == 2 and ranking.score_ranking(_poses(spark).limit(0)).count() == 0
    assert [r.pose_index for r in ranking.best_rows(_poses(spark), "name", "grid_score", ["pose_index"]).filter("name = 'tie'").collect()] == [1]


def test_ranks_against_pandas(spark):
    rnd = random.Random(3)
    data = [(f"m{i}", rnd.choice([None, *range(6)])) for i in range(200)]
    df = spark.createDataFrame(data, "name string, v int").repartition(5)
    p = df.toPandas().set_index("name").v
    for asc in (True, False):
        got = ranking.competition_rank(df, "v", "r", asc).toPandas().set_index("name").r
        want = p.rank(method="min", ascending=asc)
        assert all((math.isnan(want[n]) and math.isnan(got[n])) or want[n] == got[n] for n in want.index)
    got = ranking.average_rank(df, "v", "r").toPandas().set_index("name").r
    want = p.rank()
    assert all((math.isnan(want[n]) and math.isnan(got[n])) or want[n] == got[n] for n in want.index)
    seq = ranking.sequential_rank(df, [F.col("v").asc_nulls_last(), F.col("name")]).orderBy("rank").collect()
    assert [r["rank"] for r in seq] == list(range(1, 201)) and [(r.v is None, r.v or 0, r.name) for r in seq] == sorted((r.v is None, r.v or 0, r.name) for r in seq)


def test_engine_ranks(spark):
    data = [("a", True, -9.0, 0.5, -3.0), ("b", True, -9.0, 0.9, -4.0), ("c", False, -99.0, 0.1, -9.0), ("d", True, -7.0, None, -5.0)]
    df = spark.createDataFrame(data, "name string, success boolean, vina_affinity double, cnn_score double, cnn_affinity double")
    got = {r.name: r for r in ranking.engine_ranks(df, top_n=2).collect()}
    assert [got[n].vina_rank for n in "abcd"] == [1, 1, None, 3] and [got[n].cnn_score_rank for n in "abcd"] == [2, 1, None, None]
    assert [got[n].consensus_rank for n in "abcd"] == [2, 1, None, 2] and [got[n].is_top_n for n in "abcd"] == [True, True, False, False]


def test_conformers_and_duplicates(spark, rows):
    df = spark.createDataFrame([("a", "C", None, 0), ("a", "C", 2.0, 1), ("a", "C", 1.0, 2), ("b", "C", None, 3), ("c", None, None, 4), ("d", None, 1.0, 5)], "name string, smiles string, rmsd double, ordinal int")
    assert rows(ranking.conformers(df), "name", "ordinal", "group_size") == [("a", 2, 3), ("b", 3, 1), ("c", 4, 1), ("d", 5, 1)]
    assert rows(ranking.conformers(df, strategy="first"), "name", "ordinal")[0] == ("a", 0) and ranking.conformers(df, strategy="all").count() == 6
    assert rows(ranking.mark_duplicates(df).filter("duplicate_of is not null"), "ordinal", "duplicate_of") == [(1, "a"), (2, "a"), (3, "a")]
    with pytest.raises(ValueError):
        ranking.conformers(df, strategy="x")


def test_consensus(spark):
    a = spark.createDataFrame([("x", 1, 30), ("y", 2, 1), ("w", None, None)], "name string, gnina_vina_rank int, gnina_composite_rank int")
    b = spark.createDataFrame([("y", 3, 4), ("z", 50, 60)], "name string, dock6_best_rank int, dock6_mean_rank int")
    got = {r.name: r for r in consensus.consensus(consensus.merge_engines(a, b)).collect()}
    assert {n: r.n_lists for n, r in got.items()} == {"x": 1, "y": 4, "w": 0, "z": 0} and got["y"].avg_rank == 2.5 and got["x"].best_rank == 1 and got["w"].avg_rank is None
    assert [got[n].consensus_rank for n in "yxzw"] == [1, 2, 3, 4]
    df = consensus.consensus(consensus.merge_engines(a, b))
    assert {r.n for r in consensus.list_overlaps(df).collect()} == {1} and [r.name for r in consensus.engine_only(df, tuple(consensus.LISTS)[:2], tuple(consensus.LISTS)[2:]).collect()] == ["x"]
    clash = consensus.merge_engines(a.withColumn("mw", F.lit(1)), b.withColumn("mw", F.lit(2)))
    assert {r.name: r.mw for r in clash.collect()} == {"x": 1, "y": 1, "w": 1, "z": 2}


def test_correlations_need_enough_rows(spark):
    df = spark.createDataFrame([(float(i), float(2 * i + 1)) for i in range(4)] + [(None, 1.0)], "x double, y double")
    assert consensus.linear_fit(df, "x", "y").first().pearson is None and consensus.spearman(df, "x", "y").first().spearman == 0.0
    full = consensus.linear_fit(df, "x", "y", least=3).first()
    assert math.isclose(full.slope, 2) and math.isclose(full.intercept, 1) and math.isclose(full.pearson, 1)


def test_footprint_consistency(spark):
    data = [("a", 0, "R1", -1.0), ("a", 1, "R1", -2.0), ("a", 0, "R2", 0.0), ("b", 0, "R1", -0.5), ("c", 0, "R2", -0.6), ("c", 1, "R2", -0.4), (None, 0, "R1", -9.0)]
    df = spark.createDataFrame(data, "name string, pose_id int, residue_id string, total double").withColumns({c: F.col("total") / 2 for c in ("vdw", "es")}).withColumns({c: F.lit(0.0) for c in ("ref_vdw", "ref_es", "ref_total")})
    got = {(r.name, r.residue_id): r for r in footprint.consistency(df).collect()}
    assert set(got) == {("a", "R1"), ("a", "R2"), ("c", "R2")}  # b has one pose
    assert got["a", "R1"].consistency == 1.0 and got["a", "R2"].consistency == 0.0 and got["a", "R1"].std_total == 0.5
    w = {r.name: r for r in footprint.weighted_consistency(footprint.consistency(df)).collect()}
    assert w["a"].weighted_consistency == 1.0 and w["a"].n_significant == 1 and w["c"].weighted_consistency == 0.0  # mean exactly -0.5
    c = {r.residue_id: r for r in footprint.residue_consensus(df).collect()}
    assert c["R1"].n_molecules == 2 and c["R1"].n_contributing == 1 and c["R2"].frac_contributing == 1 / 3
    assert [r.residue_id for r in footprint.pharmacophore(footprint.residue_consensus(df), 0.3).collect()] == ["R1", "R2"]
    s = {(r.name, r.pose_id): r for r in footprint.pose_summary(df).collect()}
    assert s["a", 0].n_residues_total == 2 and s["a", 0].n_residues_contributing == 1 and s["c", 1].n_residues_contributing == 0
    assert footprint.reference_deltas(df).count() == 3


def test_numbering_map(spark, rows):
    subs = spark.createDataFrame([(i, n) for i, n in enumerate(["TRP10", "GLY11", "ASP12"])], "seq_id int, resname string")
    res = spark.createDataFrame([(i, n, 100 + i, "A") for i, n in enumerate(["TRP", "GLY", "ASP"])], "ordinal int, resname string, resid int, chain string")
    assert rows(footprint.numbering_map(subs, res)) == [(0, "TRP100.A"), (1, "GLY101.A"), (2, "ASP102.A")]
    assert footprint.numbering_map(subs.limit(2), res).count() == 0
    assert footprint.numbering_map(subs.withColumn("resname", F.lit("ALA1")), res).count() == 0


def test_spatial_join_against_brute_force(spark):
    rng = np.random.default_rng(1)
    a, b = np.round(rng.uniform(-8, 8, (80, 3)), 1), np.round(rng.uniform(-8, 8, (120, 3)), 1)
    a[0], b[0] = (0, 0, 0), (3, 0, 0)
    frame = lambda m: spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(m)] + [(-1, None, 0.0, 0.0), (-2, NAN, 0.0, 0.0)], "id int, x double, y double, z double")
    d2 = ((a[:, None] - b[None]) ** 2).sum(2)
    for inclusive in (True, False):
        got = {(r.id, r.r_id) for r in geometry.spatial_join(frame(a), frame(b), 3.0, inclusive).collect()}
        want = {(int(i), int(j)) for i, j in zip(*np.nonzero(d2 <= 9 if inclusive else d2 < 9))}
        assert {p for p in got ^ want if abs(d2[p] - 9) > 1e-9} == set() and ((0, 0) in got) == inclusive


def test_residue_contacts_count_modes(spark):
    lig = spark.createDataFrame([("m", "C1", 0.0, 0.0, 0.0), ("m", "C2", 0.5, 0.0, 0.0)], "name string, atom string, x double, y double, z double")
    rec = spark.createDataFrame([("R1.A", "CA", 1, 2.0, 0.0, 0.0), ("R1.A", "CB", 2, 4.5, 0.0, 0.0), ("R2.A", "CA", 3, 40.0, 0.0, 0.0)], "residue_id string, atom string, ord int, x double, y double, z double")
    one = geometry.residue_contacts(lig, rec, ("name",), 4.5, "receptor_atoms").first()
    assert (one.residue_id, one.min_distance, one.n_atom_contacts, one.closest_receptor_atom, one.closest_ligand_atom) == ("R1.A", 1.5, 2, "CA", "C2")
    assert geometry.residue_contacts(lig, rec, ("name",), 4.5, "atom_pairs").first().n_atom_contacts == 4
    assert geometry.residue_contacts(lig, rec, ("name",), 4.5, "atom_pairs", inclusive=False).first().n_atom_contacts == 3


def test_boxes_and_modes(spark, rows):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "x double, y double, z double")
    assert geometry.bounding_box(df, padding=0.0).first().volume == 1000.0 and geometry.bounding_box(df, 12.5).first().volume == 25.0**3
    poses = spark.createDataFrame([("m", 0, -2.0, [[0.0, 0.0, 0.0]]), ("m", 1, -1.0, [[3.0, 4.0, 0.0]]), ("m", 2, -3.0, [[0.0, 0.0, 0.0], [1.0, 1.0, 1.0]]), ("s", 0, -1.0, [[0.0, 0.0, 0.0]])], "name string, pose_index int, score double, coords array<array<double>>")
    assert rows(geometry.pose_pairs(poses), "pose_a", "pose_b", "rmsd") == [(0, 1, 5.0), (0, 2, None), (1, 2, None)]
    detail, summary = geometry.binding_modes(poses)
    got = {r.name: r for r in summary.collect()}
    assert got["m"].best_pose == 2 and got["m"].max_rmsd == 5.0 and got["s"].max_rmsd is None and got["s"].std_score == 0.0 and detail.count() == 4
    ref = geometry.reference_rmsd(poses, F.array(F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)))).filter("name = 'm'").first()
    assert (ref.n_poses, ref.best_rmsd, ref.best_pose, ref.n_below_2) == (3, 0.0, 0, 2)
    atoms = spark.createDataFrame([("A", "N", 1, 0.0, 0.0, 0.0), ("A", "CA", 2, 1.0, 0.0, 0.0), ("B", "N", 3, 30.0, 0.0, 0.0), ("B", "O", 4, 26.0, 0.0, 0.0)], "residue_id string, atom string, ord int, x double, y double, z double")
    assert rows(geometry.residue_centroids(atoms), "residue_id", "x") == [("A", 1.0), ("B", 30.0)] and geometry.within_radius(atoms, (0, 0, 0), 26.0).count() == 4


def _brute_dbscan(d, eps, least):
    near = d <= eps
    core = [i for i in range(len(d)) if near[i].sum() >= least]
    label, c = [-1] * len(d), 0
    for i in core:
        if label[i] >= 0:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if label[j] >= 0:
                continue
            label[j] = c
            if j in core:
                stack += [k for k in range(len(d)) if near[j, k] and label[k] < 0]
        c += 1
    return label


def test_dbscan(spark):
    rng = np.random.default_rng(5)
    p = np.concatenate([rng.normal(c, 0.5, (6, 3)) for c in ((0, 0, 0), (6, 0, 0))] + [[[3, 0, 0], [50, 50, 50]]])
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(2))
    assert dbscan.dbscan_labels(d, 2.0, 4).tolist() == _brute_dbscan(d, 2.0, 4)
    assert np.allclose(dbscan.pairwise_rmsd(p[:, None, :]), d, atol=1e-6)
    df = spark.createDataFrame([("m", 0, i, [list(map(float, x))]) for i, x in enumerate(p)] + [("m", 0, 99, None), ("n", 1, 0, [[0.0, 0.0, 0.0]])], "name string, fragment_id int, pose_index int, coords array<array<double>>")
    got = {(r.name, r.pose_index): r.cluster for r in dbscan.cluster_poses(df, 2.0, 4).collect()}
    assert [got["m", i] for i in range(len(p))] == _brute_dbscan(d, 2.0, 4) and got["m", 99] == got["n", 0] == -1
    pts = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(p)] + [(77, NAN, 0.0, 0.0)], "id int, x double, y double, z double")
    glob = {r.id: r.cluster for r in dbscan.dbscan_positions(pts, "id", 2.0, 4).collect()}
    want = _brute_dbscan(d, 2.0, 4)
    assert all((glob[i] is None) == (want[i] < 0) for i in range(len(p))) and len({glob[i] for i in range(6)} - {None}) == 1 and 77 not in glob


def test_dbscan_positions_against_brute_force(spark):
    rng = np.random.default_rng(8)
    p = np.round(np.concatenate([rng.uniform(-40, 40, (150, 3)), rng.normal(0, 3, (150, 3)), np.zeros((30, 3))]), 2)
    df = spark.createDataFrame([(i, "a", *map(float, x)) for i, x in enumerate(p)] + [(900 + i, "b", *map(float, x)) for i, x in enumerate(p[:50])] + [(2000, None, 0.0, 0.0, 0.0), (2001, "a", NAN, 0.0, 0.0)], "id int, s string, x double, y double, z double")
    got = {r.id: r for r in dbscan.dbscan_positions(df, "id", 2.0, 4, ("s",)).collect()}
    for ids, q in ((list(range(330)), p), (list(range(900, 950)), p[:50])):
        near = ((q[:, None] - q[None]) ** 2).sum(2) <= 4
        core = near.sum(1) >= 4
        label = np.where(core, ids, 10**6)
        while True:
            new = np.where(core, [min(label[n & core]) if c else 10**6 for n, c in zip(near, core)], 10**6)
            if (new == label).all():
                break
            label = new
        for k, i in enumerate(ids):
            around = [int(label[j]) for j in np.flatnonzero(near[k] & core)]
            assert got[i].is_core == bool(core[k]) and got[i].cluster == (int(label[k]) if core[k] else min(around, default=None))
    assert 2000 not in got and 2001 not in got


@given(st.integers(0, 10_000), st.sampled_from([30, 2_000_000]))
@settings(max_examples=25, deadline=None)
def test_link_positions(seed, chunk):
    rng = np.random.default_rng(seed)
    p = np.round(rng.uniform(0, 9, (70, 3)), 2)
    near = ((p[:, None] - p[None]) ** 2).sum(2) <= 1.5**2 + 1e-9
    b = np.arange(len(p))
    while (b != (b := np.array([b[n].min() for n in near]))).any():
        pass
    a = linking.link_positions(p, 1.5, chunk)
    assert len(set(zip(a.tolist(), b.tolist()))) == len(set(a.tolist())) == len(set(b.tolist()))


def test_link_positions_far_away():
    p = np.array([(0.0, 0, 0), (10, 0, 0), (50, 3, 1), (-1e20, 0, 0)])
    assert linking.link_positions(p, 2.0).tolist() != [0, 0, 1, 2] and len(set(linking.link_positions(p, 2.0).tolist())) == 4
    p = np.array([(1e20, 0.0, 0), (1e20, 1.5, 0), (1e300, 0, -1e300), (1e300, 0, -1e300), (2.0**40, 0, 0), (2.0**40 + 2, 0, 0), (2.0**40 + 4.5, 0, 0)])
    assert len(set(linking.link_positions(p, 2.0).tolist())) == 4  # {0, 1}, {2, 3}, {4, 5}, {6}


def _first(spark, p, reach, names=None):
    names = names or ["m"] * len(p)
    df = spark.createDataFrame([(n, i, *map(float, x)) for i, (n, x) in enumerate(zip(names, p))], "name string, node int, x double, y double, z double").repartition(4)
    got = {r.node: r.first for r in df.withColumns(linking.cells(reach)).join(linking.link_near(df, reach), ["name", *linking.CELL]).collect()}
    return [got[i] for i in range(len(p))]


@pytest.mark.parametrize(("seed", "reach"), [(1, 2.0), (2, 1.5), (3, 3.7)])
def test_link_near_against_brute_force(spark, seed, reach, monkeypatch):
    monkeypatch.setattr(linking, "GATHER", 60)
    rng = np.random.default_rng(seed)
    p = np.concatenate([rng.uniform(-14, 14, (260, 3)), np.round(rng.uniform(-3, 3, (40, 3))), [[1e20, 0, 0], [-1e20, 0, 0], [1e20, 1, 0]]])
    names = ["a" if i % 5 else "b" for i in range(300)] + ["a"] * 3
    same = np.array(names)[:, None] == np.array(names)[None]
    near = (((p[:, None] - p[None]) ** 2).sum(2) <= reach**2 + 1e-9) & same
    b = np.arange(len(p))
    while (b != (b := np.array([b[n].min() for n in near]))).any():
        pass
    assert _first(spark, p, reach, names) == b.tolist()


def test_link_near_where_boxes_are_open(spark):
    """Two sheets a hair more, or less, than the reach apart, many positions a box: only finer boxes can tell."""
    rng = np.random.default_rng(4)
    sheet = np.c_[rng.uniform(0, 0.3, (300, 2)), rng.uniform(-0.05, 0, 300)]
    for gap, joined in ((2.0 + 1e-7, False), (2.0, True)):
        p = np.concatenate([sheet, [[0.1, 0.1, 0.0]], sheet * [1, 1, -1] + [0, 0, gap], [[0.1, 0.1, gap]]])
        got = _first(spark, p, 2.0)
        assert len(set(got)) == (1 if joined else 2) and set(got[:301]) == {0}


def test_link_near_of_a_crowded_place(spark):
    """However many positions a place holds, boxes bound what a block gathers."""
    crowd = spark.range(400_000).select(F.lit("m").alias("name"), F.col("id").alias("node"), *[(F.rand(i) * 4).alias(c) for i, c in enumerate("xyz")])
    boxes = linking._boxed(crowd, linking.cell_side(2.0) / linking.SUB)
    assert boxes.count() <= (4 * linking.SUB / linking.cell_side(2.0)) ** 3 and {r.first for r in linking.link_near(crowd, 2.0).collect()} == {0}


def test_components_against_union_find(spark, rows):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(500, 500), (None, 1)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert components.connected_components(spark.createDataFrame([], "u int, v int")).count() == 0


def test_regression_against_formula(spark):
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 3, (40, 2))
    y = -5 + 2.0 * (labels[:, 0] == 1) - 1.0 * (labels[:, 0] == 2) + 0.5 * (labels[:, 1] == 2) + rng.normal(0, 0.1, 40)
    fit, parts = regression.decompose(labels, y)
    by = {(p["fragment"], p["cluster"]): p for p in parts}
    assert abs(by[0, 1]["coefficient"] - 2) < 0.2 and by[0, 0]["coefficient"] == 0.0 and fit["r2"] > 0.95 and by[0, 1]["partial_r2"] > by[1, 2]["partial_r2"]
    assert regression.decompose(labels, np.full(40, -3.0)) is None and regression.decompose(labels[:4], y[:4]) is None and regression.decompose(np.full((40, 2), -1), y) is None
    noisy = labels.copy()
    noisy[:5] = -1
    assert regression.decompose(noisy, y)[0]["n_poses"] == 35
    rows = [("m", f, i, int(labels[i, f])) for i in range(40) for f in range(2)]
    lab = spark.createDataFrame(rows, "name string, fragment_id int, pose_index int, cluster int")
    sc = spark.createDataFrame([("m", i, "s", float(y[i])) for i in range(40)], "name string, pose_index int, score_key string, value double")
    fits, table = regression.score_decomposition(lab, sc)
    assert math.isclose(fits.first().r2, fit["r2"]) and table.count() == 6


def test_fragments(spark, rows):
    lab = spark.createDataFrame([("m", 0, i, c) for i, c in enumerate([1, 1, 0, 0, -1])] + [("n", 0, 0, -1)], "name string, fragment_id int, pose_index int, cluster int")
    got = {r.name: r for r in fragments.dominant_clusters(lab, 0.5).collect()}
    assert (got["m"].dominant_cluster, got["m"].dominant_fraction, got["m"].n_noise, got["m"].sizes, got["m"].low_confidence) == (0, 0.4, 1, [2, 2], True)
    assert got["n"].dominant_cluster == -1 and got["n"].dominant_fraction == 0.0
    sc = spark.createDataFrame([("m", i, "s", float(-i)) for i in range(5)], "name string, pose_index int, score_key string, value double")
    assert rows(fragments.cluster_scores(lab, sc), "cluster", "mean", "best", "std") == [(0, -2.5, -3.0, 0.5), (1, -0.5, -1.0, 0.5)]
    assert rows(fragments.sweet_spots(lab, sc, 1), "labels", "n", "mean") == [([0], 2, -2.5)]
    full = fragments.full_consensus(lab, fragments.dominant_clusters(lab), sc).filter("name = 'm'").first()
    assert (full.n_consensus, full.mean_consensus, full.best_consensus) == (2, -2.5, -3.0)
    conv = spark.createDataFrame([("a", "r", 0.5, -2.0), ("a", "l", 1.0, -1.0), ("z", "r", 0.2, 0.0), ("z", "l", 0.4, 0.0)], "name string, fragment_label string, dominant_fraction double, weight double")
    got = {r.name: r for r in fragments.weighted_convergence(conv).collect()}
    assert math.isclose(got["a"].weighted_convergence, 2 / 3) and math.isclose(got["z"].weighted_convergence, 0.3) and got["a"].best_fragment == "l (1.00)"
    vina = spark.createDataFrame([("a", -9.0), ("z", None)], "name string, vina_affinity double")
    assert math.isclose(fragments.composite_ranking(fragments.weighted_convergence(conv), vina).first().composite_score, -6.0)


def test_fragment_energies(spark):
    terms = spark.createDataFrame([("m", 0, 0, -1.0), ("m", 0, 1, 0.5), ("m", 1, 0, -3.0), ("m", 1, 1, 1.0)], "name string, pose_index int, atom_index int, gauss1 double").withColumns({t: F.lit(0.0) for t in fragments.TERMS[1:]})
    atoms = spark.createDataFrame([("m", 0, 0), ("m", 1, 1)], "name string, fragment_id int, atom_index int")
    vina = spark.createDataFrame([("m", 0, -6.0), ("m", 1, -8.0)], "name string, pose_index int, vina double")
    got = {r.fragment_id: r for r in fragments.fragment_energies(terms, atoms, vina).collect()}
    assert got[0].vina_mean == -2.0 and got[0].vina_std == 1.0 and got[0].vina_best == -3.0 and got[1].vina_worst == 1.0
    assert math.isclose(got[0].proportional_vina_mean, (-6 * 2 / 3 - 8 * 3 / 4) / 2) and math.isclose(got[1].proportion_of_total, (1 / 3 + 1 / 4) / 2)


def test_medoids_and_hotspots(spark, rows):
    poses = spark.createDataFrame([("m", i, 0.0, [[x, 0.0, 0.0]]) for i, x in enumerate([0.0, 1.0, 2.0, 9.0])], "name string, pose_index int, score double, coords array<array<double>>")
    pairs = geometry.pose_pairs(poses).withColumn("fragment_id", F.lit(0))
    lab = spark.createDataFrame([("m", 0, i, c) for i, c in enumerate([0, 0, 0, 1])], "name string, fragment_id int, pose_index int, cluster int")
    got = fragments.medoids(pairs, lab)
    assert rows(got, "cluster", "pose_index", "size") == [(0, 1, 3), (1, 3, 1)] and fragments.selected_structures(got, 1).count() == 1
    mem = spark.createDataFrame([(5, "a", 0.0, 0.0, 0.0, True, 0.5, 0.0), (5, "b", 2.0, 0.0, 0.0, False, 0.7, -1.0), (6, "a", 9.0, 0.0, 0.0, True, 0.1, 0.0)], "hotspot int, name string, x double, y double, z double, is_ring boolean, dominant_fraction double, score_contribution double")
    got = {r.hotspot: r for r in fragments.hotspot_statistics(mem).collect()}
    assert (got[5].number, got[5].radius, got[5].n_molecules, got[5].mean_score_contribution, got[6].mean_score_contribution, got[6].number) == (0, 1.0, 2, -1.0, 0.0, 1)


def test_contacts(spark, rows):
    data = [("a", "R1", 3.0, 2, "vdw"), ("a", "R1", 5.0, 1, "weak"), ("b", "R1", 4.0, 1, "weak"), ("b", "R2", 2.0, 1, None)]
    df = spark.createDataFrame(data, "molecule_name string, residue string, min_distance double, n_atom_contacts int, contact_type string")
    got = {r.residue: r for r in contacts.contact_consensus(df).collect()}
    assert (got["R1"].n_molecules, got["R1"].mean_distance, got["R2"].frac_molecules) == (2, 4.0, 0.5)
    votes = {r.residue: r for r in contacts.contact_votes(df.withColumn("g", F.lit(1)), ["g"]).collect()}
    assert votes["R1"].dominant_type == "weak" and votes["R2"].dominant_type is None
    assert contacts.top_residues(df, 1) == ["R1"] and {r.molecule_name: r.R1 for r in contacts.heat_map(df, ["R1", "R2"]).collect()} == {"a": 3.0, "b": 4.0}
    assert rows(contacts.nearest_residues(df, ["molecule_name"], 1), "molecule_name", "residue") == [("a", "R1"), ("b", "R2")]
    c = spark.createDataFrame([("a", "R1", 3.0), ("a", "R3", 4.0)], "name string, residue_id string, min_distance double")
    f = spark.createDataFrame([("a", "R1", 1, -9.0), ("a", "R1", 0, -0.6), ("a", "R2", 0, -0.6), ("a", "R2", 1, -0.4)], "name string, residue_id string, pose_id int, total double").withColumns({"vdw": F.col("total"), "es": F.lit(0.0)})
    assert rows(contacts.contacts_and_energies(c, f), "residue_id", "total", "category") == [("R1", -0.6, "contact_and_energy"), ("R2", -0.6, "long_range_ES"), ("R3", None, "contact_only")]
    shares = contacts.share_of_group(df, "min_distance", ["molecule_name"])
    assert math.isclose(sum(r.share for r in shares.collect()), 2.0) and contacts.residue_importance(df.withColumns({"n_molecules": F.lit(1), "mean_total": -F.col("min_distance"), "residue_id": F.col("residue")}), 1).first().residue == "R1"
    assert contacts.member_contacts(df.select("molecule_name").distinct().withColumns({"fragment_id": F.lit(0), "cluster_id": F.lit(0)}), df.withColumns({"fragment_id": F.lit(0), "cluster_id": F.lit(0)})).count() == 4


def test_export(spark, rows):
    sel = spark.createDataFrame([("a",), ("dup",), ("gone",), ("REF_1",), (None,)], "name string")
    orig = spark.createDataFrame([("a", "C"), ("base", "N")], "name string, smiles string")
    dup = spark.createDataFrame([("dup", "base"), ("x", None)], "name string, duplicate_of string")
    assert rows(export.hit_export(sel, orig, dup, exclude="REF"), "name", "found_as", "smiles", "exported") == [("a", "a", "C", True), ("dup", "base", "N", True), ("gone", None, None, False)]
    assert export.unresolved(sel.filter("name is not null"), orig).count() == 3
    have, lack = export.with_files(sel.dropna(), spark.createDataFrame([("a", "p")], "name string, path string"))
    assert (have.count(), lack.count()) == (1, 3)
    one, two = spark.createDataFrame([("a", "1"), ("b", "1")], "name string, path string"), spark.createDataFrame([("a", "2"), ("c", "2")], "name string, path string")
    last = spark.createDataFrame([("b", "9")], "name string, path string")
    assert rows(export.resolve_sources(one, two, last)) == [("a", "1"), ("b", "9"), ("c", "2")]


def test_streaming(spark, tmp_path):
    schema = "name string, pose_index int, grid_score double, arrived_at timestamp"
    src = str(tmp_path / "in")
    ts = "timestamp'2025-01-01 00:10:00'"
    spark.sql(f"select * from values ('a', 0, -5.0D, {ts}), ('a', 1, -7.0D, {ts}), ('b', 0, double('nan'), {ts}) t(name, pose_index, grid_score, arrived_at)").write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    rerank.keep_best(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    spark.sql(f"select 'a' name, 2 pose_index, -9.0D grid_score, {ts} arrived_at").write.mode("append").parquet(src)
    rerank.keep_best(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [(r.name, r.pose_index, r.grid_score) for r in rerank.current_best(spark, str(tmp_path / "out")).collect()] == [("a", 2, -9.0)]
    q = rerank.best_so_far(spark.readStream.schema(schema).parquet(src)).writeStream.outputMode("complete").format("memory").queryName("best").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.name, r.best_score, r.n_poses) for r in spark.sql("select * from best").collect()] == [("a", -9.0, 3)]


def test_heat_rows_take_residues_from_the_data(spark, rows):
    data = [(f"m{m}", f"XYZ{i}.Q", float(i + m)) for i in range(30) for m in range(31 - i)] + [("m0", "XYZ0.Q", -1.0), ("m1", "XYZ0.Q", None)]
    df = spark.createDataFrame(data, "molecule_name string, residue string, min_distance double")
    got = contacts.heat_rows(df, 20).collect()
    assert {(r.place, r.residue) for r in got} == {(i + 1, f"XYZ{i}.Q") for i in range(20)} and len(got) == sum(31 - i for i in range(20))
    assert {r.molecule_name: r.min_distance for r in got if r.place == 1}["m0"] == -1.0
