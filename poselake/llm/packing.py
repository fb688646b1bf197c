"""Items into containers of fixed capacity: planned on the histogram of lengths, carried out by rank."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def plan(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit-decreasing over counts: rows (length, rank_from, first_bin, per_bin), number of bins.

    Items of ``length`` with rank r >= rank_from (up to the next row of that length) go to container
    first_bin + (r - rank_from) // per_bin. Containers are handled as ranges that share a remaining space, so the work
    depends on the lengths there are, not on the items. A length adds at most three ranges, and a range that
    takes items of length L is left with (space mod L), less than half: at most 3 * capacity * (2 + log2(capacity)) rows.
    """
    spaces: list[int] = []
    ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rows, n_bins = [], 0

    def free(space: int, first: int, count: int) -> None:
        if space > 0 and count > 0:
            if not ranges[space]:
                insort(spaces, space)
            ranges[space].append((first, count))

    for length in sorted((x for x in histogram if x > 0), reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(spaces, length)
            if k < len(spaces):
                space = spaces[k]
                first, count = ranges[space].pop()
                if not ranges[space]:
                    spaces.pop(k)
            else:
                space, first = capacity, n_bins
                count = -(-left // (capacity // length))
                n_bins += count
            per = space // length
            full = min(count, left // per)
            if full:
                rows.append((length, rank, first, per))
                free(space - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if left and full < count:  # fewer items than one more container takes
                rows.append((length, rank, first + full, per))
                free(space - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            free(space, first + full, count - full)
    return np.array(rows, np.int64).reshape(-1, 4), n_bins


def fill_containers(sizes: DataFrame, capacities: dict[int, int], key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """(container_id, bin_no, key, piece_no, size_from, size_of): where every item goes, for each container kind.

    Every row of ``sizes`` is an item of its own, packed once for each entry of ``capacities`` (id to
    capacity; non-positive capacities are an error). An item within the capacity is one piece; a larger one
    is cut into full pieces and a rest, which is packed like any item. Items of null or zero size take no
    space: they are dealt evenly over the containers in use (to container 0 if there are none). Which of
    several pieces of one length gets which planned slot: whole items first, then rests by their items' size, each by ``key``.

    One exchange, of key and size: items are range-partitioned and sorted by both, so an item's rank among
    those of its size is its place in the partition plus the counts of the partitions before; a size that a third
    of all items share is spread by the keys. The ranks of pieces follow from it by the histogram alone. The histogram
    is what the driver sees and sends: a row for each size there is, and one more for each partition. As m different sizes add up to m * m / 2
    at least, there are no more than sqrt(2 * total).
    """
    if not capacities or any(c is None or c <= 0 for c in capacities.values()):
        raise ValueError("capacities must be positive")
    kind = sizes.schema[key].dataType.simpleString()
    rows = written(sizes.select(key, F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).cast("long").alias("n")))
    in_order = rows.repartitionByRange("n", key).sortWithinPartitions("n", key)
    ranked = written(in_order.mapInArrow(_rank(key), f"`{key}` {kind}, n bigint, part int, rank bigint"))
    counts = ranked.groupBy("n", "part").agg(F.max("rank").alias("last")).orderBy("n", "part").toPandas()  # bounded, see above
    shared = sizes.sparkSession.sparkContext.broadcast(Slots(*(counts[c].to_numpy(np.int64) for c in ("n", "part", "last")), capacities))
    return ranked.mapInArrow(_assign(key, shared), f"container_id int, bin_no bigint, `{key}` {kind}, piece_no int, size_from bigint, size_of bigint")


class Slots:
    """Plans of all container kinds, and where the ranks of each size's pieces begin."""

    def __init__(self, n: np.ndarray, part: np.ndarray, last: np.ndarray, capacities: dict[int, int]):
        held = last + 1
        self.parts = int(part.max(initial=0)) + 1
        self.code = n * self.parts + part
        first = np.flatnonzero(np.r_[True, n[1:] != n[:-1]]) if len(n) else np.empty(0, np.int64)
        before = np.cumsum(held) - held
        self.base = before - np.repeat(before[first], np.diff(np.r_[first, len(n)]))
        self.sizes = n[first]
        count = np.add.reduceat(held, first) if len(n) else held
        self.kinds = {k: self._kind(count, c) for k, c in sorted(capacities.items())}

    def _kind(self, count: np.ndarray, capacity: int):
        """(capacity, full_from, rest_from, rows, codes, containers): ranks of the first full piece and the first rest of each size."""
        large = self.sizes > capacity
        lengths: dict[int, int] = dict(zip(self.sizes[~large].tolist(), count[~large].tolist()))
        full = np.where(large, count * (self.sizes // capacity), 0)
        full_from = lengths.get(capacity, 0) + np.cumsum(full) - full
        if large.any():
            lengths[capacity] = lengths.get(capacity, 0) + int(full.sum())
        rest_from = np.zeros(len(count), np.int64)
        for i in np.flatnonzero(large & (self.sizes % capacity > 0)).tolist():
            rest = int(self.sizes[i]) % capacity
            rest_from[i] = lengths.get(rest, 0)
            lengths[rest] = lengths.get(rest, 0) + int(count[i])
        rows, n_bins = plan(lengths, capacity)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        return capacity, full_from, rest_from, rows, rows[:, 0] * (1 << 44) + rows[:, 1], n_bins

    def ranks(self, n: np.ndarray, part: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return rank + self.base[np.searchsorted(self.code, n * self.parts + part)]

    def place(self, kind: int, n: np.ndarray, rank: np.ndarray, no: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Size and container of piece ``no`` of each item."""
        capacity, full_from, rest_from, rows, code, n_bins = self.kinds[kind]
        size = np.minimum(n - no * capacity, capacity)
        at = np.searchsorted(self.sizes, n)
        pieces = n // capacity
        rank = np.where(n <= capacity, rank, np.where(no < pieces, full_from[at] + rank * pieces + no, rest_from[at] + rank))
        bin_no = rank % max(n_bins, 1)  # of items without a size
        some = np.flatnonzero(size > 0)
        row = rows[np.searchsorted(code, size[some] * (1 << 44) + rank[some], side="right") - 1]
        bin_no[some] = row[:, 2] + (rank[some] - row[:, 1]) // row[:, 3]
        return size, bin_no


def _rank(key: str):
    def rank(batches):
        part = TaskContext.get().partitionId()
        last, at = None, 0  # the size that went before, and how many of it
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n").to_numpy()
            starts = np.flatnonzero(np.r_[True, n[1:] != n[:-1]])
            runs = np.diff(np.r_[starts, len(n)])
            out = np.arange(len(n)) - np.repeat(starts, runs)
            if n[0] == last:
                out[: runs[0]] += at
            last, at = n[-1], int(out[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("n"), pa.array(np.full(len(n), part, np.int32)), pa.array(out)], [key, "n", "part", "rank"])

    return rank


def _assign(key: str, shared):
    def assign(batches):
        slots = shared.value
        for batch in batches:
            n = batch.column("n").to_numpy()
            rank = slots.ranks(n, batch.column("part").to_numpy().astype(np.int64), batch.column("rank").to_numpy())
            for kind, (capacity, *_) in slots.kinds.items():
                count = np.maximum(-(-n // capacity), 1)
                ends = np.cumsum(count)
                a = 0
                while a < len(n):  # very large items: bounded rows a batch
                    b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 1_000_000, side="right")))
                    at = np.repeat(np.arange(a, b), count[a:b])
                    no = np.arange(len(at)) - np.repeat(np.cumsum(count[a:b]) - count[a:b], count[a:b])
                    size, bin_no = slots.place(kind, n[at], rank[at], no)
                    columns = [np.full(len(at), kind, np.int32), bin_no, batch.column(key).take(pa.array(at)), no.astype(np.int32), no * capacity, size]
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["container_id", "bin_no", key, "piece_no", "size_from", "size_of"])
                    a = b

    return assign


def container_summary(filled: DataFrame, capacities: dict[int, int]) -> DataFrame:
    """Per container kind: n_bins, n_pieces, n_units, unused, fill, and the least number of containers any packing needs."""
    capacity = F.create_map(*[F.lit(x) for k, c in sorted(capacities.items()) for x in (int(k), int(c))])
    bins = filled.groupBy("container_id", "bin_no").agg(F.sum("size_of").alias("used"), F.count(F.lit(1)).alias("pieces"))
    out = bins.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_bins"), F.sum("pieces").alias("n_pieces"), F.sum("used").alias("n_units"), F.max("used").alias("fullest"))
    out = out.withColumn("capacity", F.try_element_at(capacity, F.col("container_id")))
    return out.withColumns({"unused": F.col("n_bins") * F.col("capacity") - F.col("n_units"), "fill": F.col("n_units") / (F.col("n_bins") * F.col("capacity")), "least_bins": F.ceil(F.col("n_units") / F.col("capacity"))})
