"""Scores of poses explained by the clusters their fragments lie in: least squares, one molecule a group."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

FIT = "n_poses int, n_levels int, r2 double, adj_r2 double, residual_std double, intercept double"
PART = "fragment_id int, cluster int, coefficient double, std_error double, partial_r2 double, n_poses int"


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rest = float(((y - x @ beta) ** 2).sum())
    whole = float(((y - y.mean()) ** 2).sum())
    return beta, rest, 0.0 if whole <= 1e-12 else 1 - rest / whole


def decompose(labels: np.ndarray, score: np.ndarray, least: int = 5) -> tuple[dict, list[dict]] | None:
    """(fit, parts) of one molecule: poses x fragments of labels (-1: noise), a score per pose (NaN: none).

    Poses with noise or without a score don't count; below ``least`` poses without noise, or fewer than
    predictors + 2, there is no fit. Every fragment's lowest cluster is its reference with coefficient 0.
    Partial R² is what R² loses without the fragment. Kept only with R² > 0.
    """
    clean = (labels >= 0).all(1)
    if clean.sum() < least:
        return None
    use = clean & np.isfinite(score)
    lab, y = labels[use], score[use]
    if not len(y):
        return None
    columns, owner = [np.ones(len(y))], [(-1, -1)]
    levels = [sorted(set(lab[:, f])) for f in range(lab.shape[1])]
    for f, own in enumerate(levels):
        for c in own[1:]:
            columns.append((lab[:, f] == c).astype(float))
            owner.append((f, c))
    x = np.stack(columns, 1)
    n, p = len(y), x.shape[1] - 1
    if n < p + 2:
        return None
    beta, rest, r2 = _fit(x, y)
    if r2 <= 0:
        return None
    free = n - p - 1
    spread = rest / free if free > 0 else 0.0
    gram = x.T @ x
    singular = np.linalg.matrix_rank(gram) < len(gram)
    error = np.zeros(len(beta)) if singular else np.sqrt(np.maximum(np.diag(np.linalg.inv(gram)) * spread, 0))
    fit = {"n_poses": n, "n_levels": p, "r2": r2, "adj_r2": 1 - (1 - r2) * (n - 1) / free if free > 0 else r2, "residual_std": float(np.sqrt(spread)), "intercept": float(beta[0])}
    parts = []
    for f, own in enumerate(levels):
        without = [i for i, (g, _) in enumerate(owner) if g != f]
        partial = max(0.0, r2 - _fit(x[:, without], y)[2])
        for c in own:
            at = owner.index((f, c)) if (f, c) in owner else None
            parts.append({"fragment": f, "cluster": int(c), "coefficient": 0.0 if at is None else float(beta[at]), "std_error": 0.0 if at is None else float(error[at]), "partial_r2": partial, "n_poses": int((lab[:, f] == c).sum())})
    return fit, parts


def _table(pdf: pd.DataFrame) -> tuple[np.ndarray, list, np.ndarray]:
    wide = pdf.pivot_table(index="pose_index", columns="fragment_id", values="cluster", aggfunc="first").sort_index()
    score = pdf.groupby("pose_index")["value"].first().reindex(wide.index)
    return wide.fillna(-1).to_numpy(int), list(wide.columns), score.to_numpy(float)


def score_decomposition(labels: DataFrame, scores: DataFrame, least: int = 5) -> tuple[DataFrame, DataFrame]:
    """(fits, parts) of every (name, score_key); see :func:`decompose`.

    ``labels``: (name, fragment_id, pose_index, cluster); ``scores``: (name, pose_index, score_key, value).
    A group is one molecule's poses, some hundreds at most.
    """
    joined = labels.join(scores, ["name", "pose_index"]).select("name", "score_key", "fragment_id", "pose_index", "cluster", "value")

    keys = ", ".join(f"{c} {t}" for c, t in joined.dtypes[:2])
    fit, part = f"{keys}, {FIT}", f"{keys}, {PART}"

    def fits(pdf: pd.DataFrame) -> pd.DataFrame:
        table, _, score = _table(pdf)
        got = decompose(table, score, least)
        row = {"name": pdf["name"].iloc[0], "score_key": pdf["score_key"].iloc[0]}
        return pd.DataFrame([row | got[0]] if got else [], columns=[c.split()[0] for c in fit.split(", ")])

    def parts(pdf: pd.DataFrame) -> pd.DataFrame:
        table, fragments, score = _table(pdf)
        got = decompose(table, score, least)
        row = {"name": pdf["name"].iloc[0], "score_key": pdf["score_key"].iloc[0]}
        rows = [row | {"fragment_id": fragments[p.pop("fragment")]} | p for p in got[1]] if got else []
        return pd.DataFrame(rows, columns=[c.split()[0] for c in part.split(", ")])

    by = joined.groupBy("name", "score_key")
    return by.applyInPandas(fits, fit), by.applyInPandas(parts, part)
