"""Density clusters: of one molecule's poses by RMSD, and of positions across all molecules."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .geometry import spatial_join
from .linking import CELL, cells, link_near


def pairwise_rmsd(coords: np.ndarray) -> np.ndarray:
    """P x P matrix of RMSDs of P poses x A atoms x 3, without superposition."""
    flat = coords.reshape(len(coords), -1)
    norm = (flat**2).sum(1)
    d = np.maximum(norm[:, None] + norm[None, :] - 2 * flat @ flat.T, 0)
    np.fill_diagonal(d, 0)
    return np.sqrt(d / coords.shape[1])


def dbscan_labels(distance: np.ndarray, eps: float, least: int) -> np.ndarray:
    """Labels from a distance matrix: clusters in order of their first core, borders go to the first cluster that reaches them, noise is -1."""
    near = distance <= eps
    core = near.sum(1) >= least
    labels = np.full(len(distance), -1, np.int64)
    cluster = 0
    for i in np.flatnonzero(core):
        if labels[i] >= 0:
            continue
        front = np.zeros(len(distance), bool)
        front[i] = True
        while front.any():
            labels[front] = cluster
            reached = near[front & core].any(0)
            front = reached & (labels < 0)
        cluster += 1
    return labels


def cluster_poses(fragment_poses: DataFrame, eps: float = 3.0, least: int = 5) -> DataFrame:
    """(name, fragment_id, pose_index, cluster): DBSCAN of each fragment's poses by RMSD.

    ``fragment_poses``: (name, fragment_id, pose_index, coords array<array<double>>). Poses are taken in
    order; those with a null or another atom count than the fragment's first are noise. A fragment
    has some hundred poses at most, so a group fits a task; groups are independent.
    """

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pose_index", kind="stable")
        sizes = [0 if c is None else len(c) for c in pdf["coords"]]
        atoms = next((s for s in sizes if s), 0)
        ok = np.array([s == atoms and s > 0 for s in sizes])
        out = np.full(len(pdf), -1, np.int64)
        if ok.any():
            coords = np.array([np.stack(c) for c, k in zip(pdf["coords"], ok) if k], float)
            out[ok] = dbscan_labels(pairwise_rmsd(coords), eps, least)
        return pd.DataFrame({"name": pdf["name"], "fragment_id": pdf["fragment_id"], "pose_index": pdf["pose_index"], "cluster": out})

    kinds = {c: t for c, t in fragment_poses.dtypes}
    schema = f"name {kinds['name']}, fragment_id {kinds['fragment_id']}, pose_index {kinds['pose_index']}, cluster bigint"
    return fragment_poses.groupBy("name", "fragment_id").applyInPandas(label, schema)


def dbscan_positions(points: DataFrame, key: str, eps: float = 2.0, least: int = 3, on: tuple[str, ...] = ()) -> DataFrame:
    """(on..., key, cluster, is_core): DBSCAN of x, y, z in the whole table (or within ``on``), distributed.

    The cluster is the smallest key of its cores, null for noise; a border point goes to the cluster of the
    smallest such number. Points without three finite coordinates, and with a null in ``on``, are left out.

    Equal positions are one node with a weight. Nodes in grid cells narrower than ``eps`` that hold ``least``
    points are cores without any pair; pairs are made for the rest only, fewer than ``least`` a cell, against
    what is near them. Cores are linked exactly (see linking).
    """
    finite = " and ".join(f"abs({c}) != double('inf')" for c in "xyz")
    rows = points.dropna(subset=["x", "y", "z", *on]).filter(finite).select(*on, key, *[(F.col(c) + F.lit(0.0)).alias(c) for c in "xyz"])
    name = F.to_json(F.struct(*on)) if on else F.lit("")
    rows = written(rows.withColumn("name", name))
    side = eps / math.sqrt(3) * (1 - 1e-9)
    cell = {f"c{c}": F.floor(F.col(c) / side) for c in "xyz"}
    nodes = rows.groupBy("name", "x", "y", "z").agg(F.min(key).alias("node"), F.count(F.lit(1)).alias("n")).withColumns(cell)
    full = nodes.groupBy("name", *cell).agg(F.sum("n").alias("in_cell"))
    nodes = written(nodes.join(full, ["name", *cell]).select("name", "node", "n", "x", "y", "z", (F.col("in_cell") >= least).alias("dense")))
    sparse = nodes.filter(~F.col("dense"))
    near = written(spatial_join(sparse, nodes, eps, True, ("name",)).select("name", "node", F.col("r_node").alias("other"), F.col("r_n").alias("other_n")))
    more = near.groupBy("name", "node").agg(F.sum("other_n").alias("around")).filter(F.col("around") >= least).select("name", "node")
    core = written(nodes.filter("dense").select("name", "node", "x", "y", "z").unionByName(sparse.join(more, ["name", "node"], "left_semi").select("name", "node", "x", "y", "z")))
    labels = written(core.withColumns(cells(eps)).join(link_near(core, eps), ["name", *CELL]).select("name", "node", "first"))
    border = near.join(labels.select("name", F.col("node").alias("other"), "first"), ["name", "other"]).groupBy("name", "node").agg(F.min("first").alias("reached"))
    found = nodes.join(labels, ["name", "node"], "left").join(border, ["name", "node"], "left")
    found = found.select("name", "x", "y", "z", F.coalesce("first", "reached").alias("cluster"), F.col("first").isNotNull().alias("is_core"))
    return rows.join(found, ["name", "x", "y", "z"]).select(*on, key, "cluster", "is_core")
