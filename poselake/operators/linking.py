"""Positions joined by steps of a given reach: exact, in blocks whose size depends on their volume alone."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import connected_components

#: Boxes along the edge of a grid cell, and grid cells along the edge of a block.
SUB, CUBE = 8, 8
#: Boxes linked at once; blocks are gathered up to so many.
GATHER = 100_000
_AXES = "xyz"
_SUB = [f"s{c}" for c in _AXES]
CELL = [f"c{c}" for c in _AXES]


def cell_side(reach: float) -> float:
    """A power of two at most reach / sqrt(3): dividing by it is exact, and any two positions in one cell are near enough."""
    side = 2.0 ** math.floor(math.log2(reach / math.sqrt(3)))
    return side if side * math.sqrt(3) <= reach else side / 2


def whole(value: Column) -> Column:
    """The greatest integer at most ``value`` as a double, for every finite value (``floor`` is a bigint and ends at 2^63)."""
    near = F.rint(value)
    return F.when(near > value, near - 1).otherwise(near) + F.lit(0.0)


def cells(reach: float) -> dict[str, Column]:
    """cx, cy, cz: the grid cell of x, y, z, by which labels are joined back to positions."""
    return {f"c{c}": whole(F.col(c) / cell_side(reach)) for c in _AXES}


def link_near(positions: DataFrame, reach: float) -> DataFrame:
    """(name, cx, cy, cz, first): for every occupied grid cell the smallest node that its positions are joined to.

    ``positions``: (name, node, x, y, z), coordinates finite, no nulls. Two of one name belong together if at most
    ``reach`` apart (to within 1e-9 of its square) or joined by a row of such steps. A position's label is that
    of its cell (see :func:`cells`), as all positions in a cell are near each other.

    Positions are first summed up in boxes, an eighth of a cell wide: tight bounds, a count and the smallest node,
    combined before the exchange. So however many positions a place holds, a block of 8 cells' edge and the reach
    around it has at most 512 boxes a cell. Blocks compare boxes: near for certain, apart for certain, or open. A box of one
    position is never open. Open pairs whose cells are joined by nothing else are looked at again in boxes eight times
    finer, as joins, until none is open. Cells that several blocks see are joined by connected components.
    """
    kind = positions.schema["node"].dataType.simpleString()
    side = cell_side(reach)
    blocks = _boxed(positions.select("name", "node", *_AXES), side / SUB)
    for c in _AXES:  # a box within reach of a block's upper face is in the next block, too
        own, past = whole(F.col(f"lo_{c}") / (side * CUBE)), whole((F.col(f"hi_{c}") + reach * (1 + 1e-6)) / (side * CUBE))
        blocks = blocks.withColumn(f"b{c}", F.explode(F.when(own == past, F.array(own)).otherwise(F.array(own, past))))
    blocks = blocks.select(F.xxhash64("name", "bx", "by", "bz").alias("block"), "name", "bx", "by", "bz", *_SUB, "n", "node", *_bounds())
    blocks = blocks.repartition("block").sortWithinPartitions("block", "name", "bx", "by", "bz")
    pair = ", ".join(f"{p}{c} double" for p in ("a", "b", "sa", "sb") for c in _AXES)
    local = written(blocks.mapInArrow(_link(reach), f"name string, open boolean, {pair}, node {kind}"))
    cell = [F.col(f"a{c}").alias(f"c{c}") for c in _AXES]
    root = F.struct(*[F.col(f"b{c}").alias(f"c{c}") for c in _AXES])
    seen = local.filter(~F.col("open")).groupBy("name", *cell).agg(F.min(root).alias("least"), F.collect_set(root).alias("roots"), F.min("node").alias("node"))  # bounded by a cell's blocks
    vertex = lambda c: F.struct("name", c.alias("cell"))
    ties = seen.filter(F.size("roots") > 1).select("name", "least", F.explode("roots").alias("root")).filter("root <> least")
    ties = ties.select(vertex(F.col("least")).alias("u"), vertex(F.col("root")).alias("v"))
    labels = _labelled(seen, ties)
    open_ = local.filter("open").select("name", *[f"{p}{c}" for p in ("a", "b", "sa", "sb") for c in _AXES])
    if open_.limit(1).count():
        labels = _settled(positions, open_, seen, ties, labels, side / SUB, reach)
    first = labels.groupBy("name", "part").agg(F.min("node").alias("first"))
    return labels.join(first, ["name", "part"]).select("name", *CELL, "first")


def _bounds(prefix: str = "") -> list[str]:
    return [f"{prefix}{e}_{c}" for e in ("lo", "hi") for c in _AXES]


def _boxed(positions: DataFrame, side: float, *also: str) -> DataFrame:
    """(name, also..., sx, sy, sz, n, node, lo_x ... hi_z): positions by boxes of ``side``."""
    ends = [f(c).alias(f"{e}_{c}") for e, f in (("lo", F.min), ("hi", F.max)) for c in _AXES]
    placed = positions.withColumns({f"s{c}": whole(F.col(c) / side) for c in _AXES})
    return placed.groupBy("name", *also, *_SUB).agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), *ends)


def _labelled(seen: DataFrame, ties: DataFrame) -> DataFrame:
    """Cells (name, cx, cy, cz, node) with ``part``, the cell that stands for what they are joined to."""
    joined = connected_components(ties).select(F.col("node.name").alias("name"), F.col("node.cell").alias("least"), F.col("component.cell").alias("to"))
    return seen.join(joined, ["name", "least"], "left").select("name", *CELL, "node", F.coalesce("to", "least").alias("part"))


def _settled(positions: DataFrame, open_: DataFrame, seen: DataFrame, ties: DataFrame, labels: DataFrame, side: float, reach: float) -> DataFrame:
    """Labels with the open pairs of boxes decided, each level in boxes an eighth as wide."""
    limit = reach * reach + 1e-9
    pairs = open_.distinct()
    while True:
        labels = written(labels)
        for p in "ab":
            pairs = pairs.join(labels.select("name", *[F.col(f"c{c}").alias(f"{p}{c}") for c in _AXES], F.col("part").alias(f"part_{p}")), ["name", *[f"{p}{c}" for c in _AXES]])
        pairs = written(pairs.filter("part_a <> part_b"))  # what has been joined meanwhile needs no answer
        if not pairs.limit(1).count():
            return labels
        box = {p: F.struct(*[F.col(f"s{p}{c}").alias(f"p{c}") for c in _AXES]) for p in "ab"}
        wanted = pairs.select("name", F.explode(F.array(box["a"], box["b"])).alias("parent")).distinct()
        parents = positions.select("name", "node", *_AXES).withColumn("parent", F.struct(*[whole(F.col(c) / side).alias(f"p{c}") for c in _AXES]))
        side /= SUB
        fine = written(_boxed(parents.join(wanted, ["name", "parent"], "left_semi"), side, "parent"))
        both = pairs.withColumns({f"parent_{p}": box[p] for p in "ab"})
        for p in "ab":
            both = both.join(fine.select("name", F.col("parent").alias(f"parent_{p}"), *[F.col(c).alias(f"{p}_{c}") for c in (*_SUB, *_bounds())]), ["name", f"parent_{p}"])
        apart = [F.greatest(F.lit(0.0), F.col(f"a_lo_{c}") - F.col(f"b_hi_{c}"), F.col(f"b_lo_{c}") - F.col(f"a_hi_{c}")) for c in _AXES]
        across = [F.greatest(F.col(f"a_hi_{c}") - F.col(f"b_lo_{c}"), F.col(f"b_hi_{c}") - F.col(f"a_lo_{c}")) for c in _AXES]
        squares = lambda d: d[0] * d[0] + d[1] * d[1] + d[2] * d[2]
        children = [F.col(f"{p}_s{c}").alias(f"s{p}{c}") for p in "ab" for c in _AXES]
        both = written(both.filter(squares(apart) <= limit).select("name", *[f"{p}{c}" for p in "ab" for c in _AXES], *children, "part_a", "part_b", (squares(across) <= limit).alias("near")))
        found = both.filter("near").select(*[F.struct("name", F.col(f"part_{p}").alias("cell")).alias(v) for p, v in (("a", "u"), ("b", "v"))]).distinct()
        ties = written(ties.unionByName(found))
        labels = _labelled(seen, ties)
        pairs = both.filter(~F.col("near")).select("name", *[f"{p}{c}" for p in ("a", "b", "sa", "sb") for c in _AXES])


# In a task -----------------------------------------------------------------------------------------
def _link(reach: float):
    """Blocks of a sorted partition, several at a time: a row for every cell, and one for every open pair of boxes."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column("block").to_numpy(), batch.column("name").dictionary_encode().indices.to_numpy(), *[batch.column(f"b{c}").to_numpy() for c in _AXES]]
            new = np.zeros(batch.num_rows, bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            head = tuple(batch.column(c)[0].as_py() for c in ("name", "bx", "by", "bz"))
            new[0] = head != last
            last = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in ("name", "bx", "by", "bz"))
            cuts = np.flatnonzero(new)
            if rows + batch.num_rows > GATHER and len(cuts):
                held.append(batch.slice(0, cuts[-1]))
                yield from _linked(held, reach)
                held, rows, batch = [], 0, batch.slice(cuts[-1])
            held.append(batch)
            rows += batch.num_rows
        yield from _linked(held, reach)

    return run


def _linked(parts: list[pa.RecordBatch], reach: float):
    parts = [p for p in parts if p.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts).combine_chunks()
    column = lambda c: table.column(c).to_numpy()
    name = table.column("name").combine_chunks()
    code = name.dictionary_encode().indices.to_numpy()
    block = np.stack([code, *[np.unique(column(f"b{c}"), return_inverse=True)[1] for c in _AXES]], 1)
    block = np.unique(block, axis=0, return_inverse=True)[1].ravel()
    sub = np.stack([column(c) for c in _SUB], 1)
    grid = np.floor(sub / SUB)
    lo, hi = (np.stack([column(f"{e}_{c}") for c in _AXES], 1) for e in ("lo", "hi"))
    order, start, label, open_ = link_boxes(block, grid, lo, hi, reach)
    node = table.column("node").combine_chunks().take(pa.array(order))
    by_node = np.lexsort((node.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(order)]))))
    least = node.take(pa.array(by_node[start]))  # the smallest node of each cell
    at = order[start]
    empty = pa.nulls(len(at), pa.float64())
    names = ["name", "open", *[f"{p}{c}" for p in ("a", "b", "sa", "sb") for c in _AXES], "node"]
    yield pa.RecordBatch.from_arrays([name.take(pa.array(at)), pa.array(np.zeros(len(at), bool)), *[pa.array(grid[at, i]) for i in range(3)], *[pa.array(grid[at[label], i]) for i in range(3)], *[empty] * 6, least], names)
    if len(open_):
        a, b = open_.T
        some = pa.array(np.ones(len(a), bool))
        yield pa.RecordBatch.from_arrays([name.take(pa.array(a)), some, *[pa.array(v[p, i]) for v in (grid, sub) for p in (a, b) for i in range(3)], pa.nulls(len(a), node.type)], names)


def link_boxes(block: np.ndarray, grid: np.ndarray, lo: np.ndarray, hi: np.ndarray, reach: float, chunk: int = 2_000_000) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, start, label, open) of boxes with bounds ``lo`` and ``hi`` in grid cells of :func:`cell_side`.

    ``order`` puts boxes of one block and cell together, ``start`` is where each cell begins in it, ``label`` the first
    cell that a cell is joined to within its block. ``open``: pairs of boxes, in cells not joined, that may or may not be near.
    """
    steps = math.floor(reach / cell_side(reach)) + 1
    axes = np.stack([block.astype(np.int64), *[_closed(grid[:, i], steps + 1) for i in range(3)]], 1)
    order = np.lexsort(axes.T[::-1])
    placed = axes[order]
    start = np.flatnonzero(np.r_[True, (placed[1:] != placed[:-1]).any(1)]) if len(order) else np.empty(0, np.int64)
    own, count = placed[start], np.diff(np.r_[start, len(order)])
    lo, hi = lo[order], hi[order]
    code, weight = _codes(own)
    by_code = np.argsort(code)
    sorted_code = code[by_code]
    label = np.arange(len(start))
    limit = reach * reach + 1e-9
    shifts = [(i, j, k) for i in range(-steps, steps + 1) for j in range(-steps, steps + 1) for k in range(-steps, steps + 1) if (i, j, k) > (0, 0, 0) and sum(max(abs(x) - 1, 0) ** 2 for x in (i, j, k)) * cell_side(reach) ** 2 <= limit]
    unsure = []
    for shift in sorted(shifts, key=lambda s: sum(x * x for x in s)):
        move = np.array([0, *shift], np.int64)
        with np.errstate(over="ignore"):
            near = sorted_code + (move.astype(np.uint64) * weight).sum(dtype=np.uint64)
        at = np.minimum(np.searchsorted(sorted_code, near), len(by_code) - 1)
        found = np.flatnonzero(sorted_code[at] == near)
        a, b = by_code[found], by_code[at[found]]
        some = (own[b] == own[a] + move).all(1) & (label[a] != label[b])
        a, b = a[some], b[some]
        work = np.cumsum(count[a] * count[b])
        done, sure = 0, []
        while done < len(a):
            end = max(done + 1, int(np.searchsorted(work, (work[done - 1] if done else 0) + chunk, side="right")))
            hit, maybe = _touching(lo, hi, start, count, a[done:end], b[done:end], limit, chunk)
            sure.append(done + hit)
            unsure += [maybe] if len(maybe) else []
            done = end
        if sure and len(hit := np.concatenate(sure)):
            label = _join(label, a[hit], b[hit])
    open_ = np.concatenate(unsure) if unsure else np.empty((0, 2), np.int64)
    if len(open_):
        of = np.repeat(np.arange(len(start)), count)
        open_ = order[open_[label[of[open_[:, 0]]] != label[of[open_[:, 1]]]]]
    return order, start, label, open_


def link_positions(xyz: np.ndarray, reach: float, chunk: int = 2_000_000) -> np.ndarray:
    """Component number of each position, two being joined if at most ``reach`` apart (to within 1e-9 of its square); any finite coordinates."""
    order, start, label, _ = link_boxes(np.zeros(len(xyz), np.int64), np.floor(xyz / cell_side(reach)), xyz, xyz, reach, chunk)
    out = np.empty(len(xyz), np.int64)
    out[order] = np.repeat(label, np.diff(np.r_[start, len(order)]))
    return out


def _closed(values: np.ndarray, most: int) -> np.ndarray:
    """Whole numbers of any size as small ones: gaps wider than ``most`` are closed to it, others stay."""
    if not len(values):
        return np.empty(0, np.int64)
    unique, at = np.unique(values, return_inverse=True)
    with np.errstate(over="ignore"):
        return np.r_[0, np.cumsum(np.minimum(np.diff(unique), most).astype(np.int64))][at.ravel()]


def _codes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct row, linear in its places (modulo 2^64) so that a neighbour's follows from it."""
    rng = np.random.default_rng(1)
    while True:
        weight = rng.integers(1, 1 << 63, rows.shape[1], dtype=np.uint64) | np.uint64(1)
        code = (rows.astype(np.uint64) * weight).sum(1, dtype=np.uint64)
        if len(np.unique(code)) == len(rows):
            return code, weight


def _touching(lo, hi, start, count, a, b, limit, chunk) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of grid cells have two boxes near for certain, and the open pairs of boxes of the others."""
    if len(a) == 1 and count[a[0]] * count[b[0]] > chunk:
        right = slice(start[b[0]], start[b[0]] + count[b[0]])
        step, open_ = max(1, chunk // count[b[0]]), []
        for at in range(start[a[0]], start[a[0]] + count[a[0]], step):
            left = slice(at, min(at + step, start[a[0]] + count[a[0]]))
            gap = (np.maximum(0, np.maximum(lo[left, None] - hi[None, right], lo[None, right] - hi[left, None])) ** 2).sum(2)
            i, j = np.nonzero(gap <= limit)
            far = (np.maximum(hi[at + i] - lo[start[b[0]] + j], hi[start[b[0]] + j] - lo[at + i]) ** 2).sum(1)
            if (far <= limit).any():
                return np.array([0]), np.empty((0, 2), np.int64)
            open_.append(np.stack([at + i, start[b[0]] + j], 1))
        return np.empty(0, np.int64), np.concatenate(open_)
    n = count[a] * count[b]
    pair = np.repeat(np.arange(len(a)), n)
    place = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    left = start[a][pair] + place // count[b][pair]
    right = start[b][pair] + place % count[b][pair]
    with np.errstate(over="ignore"):
        near = np.flatnonzero((np.maximum(0, np.maximum(lo[left] - hi[right], lo[right] - hi[left])) ** 2).sum(1) <= limit)
        left, right, pair = left[near], right[near], pair[near]
        sure = (np.maximum(hi[left] - lo[right], hi[right] - lo[left]) ** 2).sum(1) <= limit
    hit = np.unique(pair[sure])
    maybe = np.flatnonzero(~sure)
    if len(maybe):
        maybe = maybe[~np.isin(pair[maybe], hit)]
    return hit, np.stack([left[maybe], right[maybe]], 1)


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining cells a[i] and b[i]: the least label of each component."""
    parent = np.arange(len(label))
    x, y = label[a], label[b]
    while True:
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(parent, high, low)
        while (up := parent[parent] != parent).any():
            parent[up] = parent[parent[up]]
        x, y = parent[x], parent[y]
        if (x == y).all():
            return parent[label]
        keep = x != y
        x, y = x[keep], y[keep]
