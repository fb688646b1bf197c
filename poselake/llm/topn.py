"""The N best items of every group, by merging sorted runs through a loser tree."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Items of a group that may share a run: neighbouring ties go together, a larger group is split.
RUN_SPAN = 256


class LoserTree:
    """Tournament over k cursors; ``keys[i]`` is the current key of run i, None once the run is used up."""

    def __init__(self, keys: list):
        self.k = max(1, len(keys))
        self.keys = list(keys) or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i, building=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        if y is None:
            return x is not None or a < b
        return x is not None and (x < y or (x == y and a < b))

    def _play(self, i: int, building: bool = False) -> None:
        winner, node = i, (i + self.k) >> 1
        while node > 0:
            other = self.losers[node]
            if other < 0:
                if building:
                    self.losers[node] = winner
                    return
            elif self._beats(other, winner):
                self.losers[node], winner = winner, other
            node >>= 1
        self.losers[0] = winner

    @property
    def winner(self) -> int:
        return self.losers[0]

    def replace(self, i: int, key) -> None:
        """Run ``i``, the present winner, moves on to ``key``."""
        self.keys[i] = key
        self._play(i)


def merge_runs(runs: Sequence[tuple[np.ndarray, list, np.ndarray]], n: int) -> Iterator[int]:
    """Row numbers of the first ``n`` of each group over all runs.

    A run is (group codes ascending, comparable keys, row numbers), sorted by group and key. After ``n``
    outputs of a group each run that still stands in it seeks, by binary search, to its next group.
    """
    at = [0] * len(runs)
    key = [(lambda r: lambda p: (int(r[0][p]), r[1][p]) if p < len(r[0]) else None)(r) for r in runs]
    tree = LoserTree([key[i](0) for i in range(len(runs))])
    group, taken = None, 0
    while (i := tree.winner) >= 0 and tree.keys[i] is not None:
        g = tree.keys[i][0]
        if g != group:
            group, taken = g, 0
        if taken < n:
            yield int(runs[i][2][at[i]])
            taken += 1
            at[i] += 1
        else:
            at[i] = int(np.searchsorted(runs[i][0], g, side="right"))
        tree.replace(i, key[i](at[i]))


def top_n_per_group(df: DataFrame, group: str, score: str, tie: str, n: int = 3, span: int = RUN_SPAN) -> DataFrame:
    """The ``n`` rows of each ``group`` with the lowest ``score``, equal scores by ``tie`` ascending.

    ``tie`` must be a whole number. Rows with null group, or with null or non-finite score, are left out; a null ``tie`` sorts
    last; rows equal in all three are told apart by nothing and any of them may stand for the others.
    Extra columns are carried along. Columns come out as they went in.

    1. Runs: rows are exchanged by (group, tie div ``span``), so a group of millions of items becomes many
       runs and a usual one a single run; each partition is sorted by group, score and tie (external sort),
       and every run ends a group after ``n`` rows.
    2. Merge: what is left, at most ``n`` rows of a group and run, is exchanged by group and the runs are
       merged by a loser tree that seeks to the next group after ``n`` outputs.
    """
    clean = df.filter(F.col(group).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & (F.abs(F.col(score).cast("double")) != float("inf")))
    names = df.columns
    slots = clean.withColumn("__slot", F.coalesce(F.floor(F.col(tie) / span).cast("long"), F.lit(-1).cast("long")))
    slots = slots.repartition(F.col(group), F.col("__slot"))
    order = [F.col(group).asc(), F.col(score).asc(), F.col(tie).asc_nulls_last()]
    run = slots.sortWithinPartitions(*order).drop("__slot").withColumn("__run", F.spark_partition_id())
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in df.schema.fields], T.StructField("__run", T.IntegerType(), True)])
    ended = run.mapInArrow(_end_groups(group, n), schema)
    gathered = ended.repartition(F.col(group)).sortWithinPartitions(F.col("__run"), *order)
    return gathered.mapInArrow(_merge(group, score, tie, n, names), T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields]))


def _end_groups(group: str, n: int):
    def scan(batches):
        last, seen = None, 0  # the group open at the end of the batch before
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _codes(batch.column(group))
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
            first, final = batch.column(group)[0].as_py(), batch.column(group)[len(codes) - 1].as_py()
            if first == last:
                end = starts[1] if len(starts) > 1 else len(codes)
                place[:end] += seen
            last, seen = final, int(place[-1]) + 1
            yield batch.filter(pa.array(place < n))

    return scan


def _codes(column: pa.Array) -> np.ndarray:
    """A number per value such that equal neighbours are equal; ascending for a sorted column."""
    encoded = column.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False)


def _merge(group: str, score: str, tie: str, n: int, names: list[str]):
    def merge(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        ordered = table.column(group).combine_chunks().dictionary_encode()
        rank = np.empty(len(ordered.dictionary), np.int64)
        # Any total order will do as long as all runs share it; the runs are sorted by it below.
        values = ordered.dictionary.to_pylist()
        rank[sorted(range(len(values)), key=lambda i: values[i].encode() if isinstance(values[i], str) else values[i])] = np.arange(len(values))
        codes = rank[ordered.indices.to_numpy(zero_copy_only=False)]
        scores = table.column(score).to_numpy().astype(float)
        ties = table.column(tie)
        missing = np.asarray(ties.is_null())
        tie_keys = np.where(missing, np.iinfo(np.int64).max, ties.fill_null(0).to_numpy().astype(np.int64))
        run = table.column("__run").to_numpy()
        bounds = np.r_[np.flatnonzero(np.r_[True, run[1:] != run[:-1]]), len(run)]
        runs = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            runs.append((codes[a:b], list(zip(scores[a:b].tolist(), tie_keys[a:b].tolist())), np.arange(a, b)))
        picked = np.fromiter(merge_runs(runs, n), np.int64)
        yield from table.select(names).take(pa.array(picked)).to_batches()

    return merge
