"""Similarity clusters: distributed k-means with parallel oversampled seeding, and exact groups of near positions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.linking import CELL, cells, link_near
from ..session import written

#: Vectors compared with all centres at once.
ROWS = 2048
#: Rows of one frame that a task compares with the frame's centres.
PART = 50_000


def hashed_features(numeric: dict[str, float], categorical: dict[str, float], slots: int = 8) -> Column:
    """array<double> of weighted features: one place per number, and ``slots`` shared by hashed categories.

    A category ``name=value`` adds its weight, with a hashed sign, to two hashed slots; nulls are a value.
    Numbers must not be null.
    """
    parts = [F.col(c).cast("double") * w + F.lit(0.0) for c, w in numeric.items()]
    sums = []
    for s in range(slots):
        total = F.lit(0.0)
        for c, w in categorical.items():
            value = F.coalesce(F.col(c).cast("string"), F.lit("\x00"))
            for turn in (0, 1):
                h = F.xxhash64(F.lit(f"{c}{turn}"), value)
                total = total + F.when(F.pmod(h, F.lit(slots)) == s, F.when(F.pmod(F.shiftright(h, 20), F.lit(2)) == 0, w).otherwise(-w)).otherwise(0.0)
        sums.append(total)
    return F.array(*parts, *sums)


def _matrix(table: pa.Table, name: str = "p") -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, the first of equals, and the squared distance, computed without cancellation."""
    which, far = np.empty(len(points), np.int64), np.empty(len(points))
    size = (centres**2).sum(1)[None, :]
    for a in range(0, len(points), ROWS):
        some = points[a : a + ROWS]
        which[a : a + ROWS] = (size - 2 * some @ centres.T).argmin(1)
        far[a : a + ROWS] = ((some - centres[which[a : a + ROWS]]) ** 2).sum(1)
    return which, far


def _centres(table: pa.Table) -> np.ndarray:
    """The centres of a frame in one order, whatever theirs of arrival."""
    return np.unique(_matrix(table), axis=0)


def _lists(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows, np.float64)
    width = rows.shape[1] if rows.ndim == 2 else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(rows.ravel()))


def _reduce(points: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted k-means++ of the candidates."""
    if len(points) <= k:
        return points
    rng = np.random.default_rng(seed)
    weight = np.maximum(weight, 1e-9)
    kept = [int(rng.choice(len(points), p=weight / weight.sum()))]
    far = ((points - points[kept[0]]) ** 2).sum(1)
    for _ in range(k - 1):
        mass = far * weight
        if mass.sum() <= 0:
            break
        kept.append(int(rng.choice(len(points), p=mass / mass.sum())))
        far = np.minimum(far, ((points - points[kept[-1]]) ** 2).sum(1))
    return points[kept]


def frame_clusters(df: DataFrame, space: list[str], key: str, vector: Column, typical: int = 3, seed: int = 7, rounds: int = 3, steps: int = 10) -> DataFrame:
    """(space..., cluster, n_members, radius, typical array<key>): k-means clusters within each ``space``, whose nulls are a value.

    ``vector`` is an array of doubles of one length (see :func:`hashed_features`); rows with a null, NaN or infinity in it
    are left out. A row is only compared with centres of its own space; a space of n rows gets ceil(sqrt(n / 2)) centres
    (fewer if it has fewer distinct vectors). Equal distances go by the centre's and the ``key``'s order; an empty table gives no rows.

    Parallel oversampled seeding: each of ``rounds`` draws 2k / rounds vectors with a chance in proportion to rows
    and squared distance from those drawn (the smallest -ln(u) / mass, u a hash of vector and round, so a task that runs again
    draws the same). Candidates, weighted by the rows nearest to them, are reduced to k. Then Lloyd steps, until no centre
    moves by 1e-3 or ``steps`` are done; means are added up in each task first.

    Equal vectors are one, with a weight. A space's vectors are dealt to tasks, ``PART`` each, and each task gets the
    centres of its space only, so neither a hot space nor the number of spaces bounds anything; nothing reaches the driver.
    """
    name = F.to_json(F.struct(*space), {"ignoreNullFields": "false"})
    rows = df.select(name.alias("frame"), F.struct(*space).alias("space"), F.col(key).alias("key"), vector.alias("p"))
    rows = written(rows.filter(F.forall("p", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))))
    sizes = rows.groupBy("frame").agg(F.first("space").alias("space"), F.count(F.lit(1)).alias("n"), F.min_by("p", F.struct(F.xxhash64("p", F.lit(seed)), "p")).alias("p"))
    sizes = written(sizes.withColumns({"k": F.ceil(F.sqrt(F.col("n") / 2)).cast("int"), "slots": F.ceil(F.col("n") / PART).cast("int")}))
    slot = lambda df, by: df.join(sizes.select("frame", "k", "slots"), "frame").withColumn("slot", F.pmod(F.xxhash64(by), "slots").cast("int"))
    nodes = written(slot(rows.groupBy("frame", "p").agg(F.count(F.lit(1)).alias("n")), "p").select("frame", "slot", "p", "n"))

    def against(points: DataFrame, centres: DataFrame, each, schema: str) -> DataFrame:
        """``each(points, centres, k)`` for every part of a frame's points."""
        held = centres.select("frame", "p").join(sizes.select("frame", "k", "slots"), "frame").select("frame", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"), "k", "p")
        names = [c.split()[0] for c in schema.split(", ")]

        def call(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return out.empty_table()
            frame, columns = left.column("frame")[0].as_py(), each(left, _centres(right), right.column("k")[0].as_py())
            return pa.table([pa.array([frame] * len(columns[0]), pa.string()), *columns], names=names).cast(out)

        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import _parse_datatype_string

        out = to_arrow_schema(_parse_datatype_string(schema))
        return points.groupBy("frame", "slot").cogroup(held.groupBy("frame", "slot")).applyInArrow(call, schema)

    def drawn(left, centres, k):
        points = _matrix(left)
        mass = _nearest(points, centres)[1] * left.column("n").to_numpy()
        far = np.flatnonzero(mass > 0)
        odds = -np.log(left.column("u").to_numpy()[far]) / mass[far]
        best = np.argsort(odds, kind="stable")[: -(-2 * k // rounds)]
        return [_lists(points[far[best]]), pa.array(odds[best]), pa.array(np.full(len(best), k, np.int32))]

    def weighed(left, centres, k):
        n = np.bincount(_nearest(_matrix(left), centres)[0], left.column("n").to_numpy(), len(centres))
        return [_lists(centres), pa.array(n), pa.array(np.full(len(centres), k, np.int32))]

    def summed(left, centres, k):
        points, n = _matrix(left), left.column("n").to_numpy()
        which = _nearest(points, centres)[0]
        total = np.stack([np.bincount(which, points[:, i] * n, len(centres)) for i in range(points.shape[1])], 1)
        return [_lists(centres), _lists(total), pa.array(np.bincount(which, n, len(centres)))]

    def placed(left, centres, k):
        which, far = _nearest(_matrix(left), centres)
        return [left.column("key").combine_chunks(), pa.array(which), pa.array(np.sqrt(far))]

    centres = sizes.select("frame", "p")
    for turn in range(rounds):
        u = (F.pmod(F.xxhash64("p", F.lit(seed), F.lit(turn)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
        some = against(nodes.withColumn("u", u), centres, drawn, "frame string, p array<double>, odds double, k int")
        at = F.row_number().over(Window.partitionBy("frame").orderBy("odds", "p"))
        centres = written(centres.unionByName(some.withColumn("at", at).filter(F.col("at") <= F.ceil(2 * F.col("k") / rounds)).select("frame", "p")))
    weights = against(nodes, centres, weighed, "frame string, p array<double>, n double, k int").groupBy("frame", "p", "k").agg(F.sum("n").alias("n"))

    def reduced(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(at=group["p"].map(tuple)).sort_values("at")
        kept = _reduce(np.stack(group["p"].to_list()).astype(float), group["n"].to_numpy(float), int(group["k"].iloc[0]), seed)
        return pd.DataFrame({"frame": [group["frame"].iloc[0]] * len(kept), "p": list(kept)})

    centres = written(weights.groupBy("frame").applyInPandas(reduced, "frame string, p array<double>"))  # about 2k candidates a space
    for _ in range(steps):
        sums = against(nodes, centres, summed, "frame string, c array<double>, total array<double>, n double").filter("n > 0").select("frame", "c", "n", F.posexplode("total").alias("at", "x"))
        means = sums.groupBy("frame", "c", "at").agg((F.sum("x") / F.sum("n")).alias("x")).groupBy("frame", "c").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("p"))
        moved = written(means)
        centres = moved.select("frame", "p")
        if not moved.filter(F.exists(F.zip_with("c", "p", lambda a, b: F.abs(a - b)), lambda x: x > 1e-3)).limit(1).count():
            break
    found = written(against(slot(rows.select("frame", "key", "p"), "key").select("frame", "slot", "key", "p"), centres, placed, f"frame string, key {rows.schema['key'].dataType.simpleString()}, cluster bigint, d double"))
    by = ["frame", "cluster"]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("d", "key"))).filter(F.col("rank") <= typical)
    near = ranked.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "key"))), lambda x: x["key"]).alias("typical"))
    sized = found.groupBy(*by).agg(F.count(F.lit(1)).alias("n_members"), F.max("d").alias("radius"))
    return sized.join(near, by).join(sizes.select("frame", "space"), "frame").select(*[F.col("space")[s].alias(s) for s in space], "cluster", "n_members", "radius", "typical")


# Groups of near positions ---------------------------------------------------------------------------
def near_groups(df: DataFrame, space: list[str], key: str, xyz: tuple[str, str, str], reach: float = 2.0, part: str | None = None, least: int = 1) -> DataFrame:
    """(space..., key, x, y, z, first_id): every row with the smallest key of its group.

    Within one ``space`` two rows belong together if at most ``reach`` apart or joined by a row of such steps.
    Rows whose coordinates aren't three finite numbers are left out; nulls in ``space`` are a value; keys
    must be distinct within a space. With ``part``, only groups with ``least`` different values of that column come out.

    k-means can't give such chains: a chain is no ball around a centre. The links are exact (see
    :func:`poselake.operators.linking.link_near`): positions are summed up in small boxes first, blocks of boxes are
    linked in tasks, and blocks are joined by connected components.
    """
    ok = F.lit(True)
    for c in xyz:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    name = F.to_json(F.struct(*space), {"ignoreNullFields": "false"})
    rows = df.filter(ok).select(name.alias("name"), F.struct(*space).alias("space"), F.col(key).alias("node"), *([F.col(part).alias("part")] if part else []), *[(F.col(c).cast("double") + F.lit(0.0)).alias(a) for c, a in zip(xyz, "xyz")])
    rows = written(rows)
    labels = written(link_near(rows, reach))
    placed = rows.withColumns(cells(reach)).join(labels, ["name", *CELL])
    if part:
        listed = placed.groupBy("name", "first").agg(F.countDistinct("part").alias("parts")).filter(F.col("parts") >= least).select("name", "first")
        placed = placed.join(listed, ["name", "first"])
    return placed.select(*[F.col("space")[s].alias(s) for s in space], F.col("node").alias(key), *[F.col(a).alias(c) for c, a in zip(xyz, "xyz")], F.col("first").alias("first_id"))


def typical_members(placed: DataFrame, space: list[str], key: str, xyz: tuple[str, str, str], typical: int = 3) -> DataFrame:
    """(space..., first_id, n_members, radius, typical): size of each group of :func:`near_groups` and its members nearest the mean."""
    by = [*space, "first_id"]
    centre = placed.groupBy(*by).agg(F.count(F.lit(1)).alias("n_members"), *[F.avg(c).alias(f"c_{c}") for c in xyz])
    own = centre.withColumnsRenamed({c: f"_{c}" for c in by})
    far = [(F.col(c) - F.col(f"c_{c}")) * (F.col(c) - F.col(f"c_{c}")) for c in xyz]
    placed = placed.join(own, [placed[c].eqNullSafe(own[f"_{c}"]) for c in by]).withColumn("d", F.sqrt(far[0] + far[1] + far[2]))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("d", key))).filter(F.col("rank") <= typical)
    near = ranked.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", key))), lambda x: x[key]).alias("typical"))
    near = near.withColumnsRenamed({c: f"_{c}" for c in by})
    sized = placed.groupBy(*by, "n_members").agg(F.max("d").alias("radius"))
    return sized.join(near, [sized[c].eqNullSafe(near[f"_{c}"]) for c in by]).select(*by, "n_members", "radius", "typical")
