"""Which items appear together, how often, and how far beyond chance: stripes and log-likelihood ratio."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Left items of one unit of work at least, and units of one basket at most; a larger basket is worked on in several tasks.
SEGMENT, UNITS = 512, 128
#: Expanded pairs held at once, and distinct ones gathered before stripes are sent on.
CHUNK, HELD = 2_000_000, 4_000_000
#: Parts of a stripe, by its neighbours: an item that is everywhere is merged in so many tasks.
SPREAD = 16
#: Neighbours in one row of a stripe that is sent.
WIDE = 512
_STRIPE = "item string, part int, neighbours array<string>, counts array<bigint>"


def stripes(baskets: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(item, part, neighbours array<string>, counts array<bigint>): partial stripes of each partition.

    ``baskets`` has one array ``items`` of distinct strings per basket. An item's stripe counts, per
    neighbour that sorts after it, the baskets of both; the item itself is its own first neighbour, which
    gives the item's baskets. The stripe of the empty item counts the baskets. ``part`` is a hash of the neighbours.
    A basket with many items is taken ``segment`` left items at a time (more, where that would be over ``UNITS`` times), each
    in a row of its own that can go to any task with the items at and after them; counts are gathered in the task, so
    pairs are neither shuffled nor held.
    """
    size = F.size("items")
    span = F.greatest(F.lit(segment), F.ceil(size / UNITS)).cast("int")
    units = baskets.select(F.array_sort("items").alias("items")).select("items", size.alias("size"), span.alias("span"))
    units = units.select("items", "size", "span", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / F.col("span")).cast("int"))).alias("unit"))
    start = F.col("unit") * F.col("span")
    units = units.select(F.slice("items", start + 1, F.col("size") - start).alias("items"), F.least("span", F.col("size") - start).alias("left"), (F.col("unit") == 0).alias("first"))
    return units.mapInArrow(_gather, _STRIPE)


def merged_stripes(partial: DataFrame) -> DataFrame:
    """Whole stripes, in the columns of :func:`stripes`: partial ones meet by item and part, and their arrays are merged by neighbour.

    A task holds one part of one item's stripe, a sixteenth of the item's distinct neighbours.
    """
    return partial.repartition("item", "part").sortWithinPartitions("item", "part").mapInArrow(_merge, _STRIPE)


def _rows(item: pa.Array, part: np.ndarray, neighbour: pa.Array, count: pa.Array, starts: np.ndarray):
    """A record batch of stripes from flat, ordered columns; ``starts`` is where each begins, long ones are cut."""
    ends = np.r_[starts[1:], len(count)]
    pieces = -(-(ends - starts) // WIDE)
    starts = np.repeat(starts, pieces) + WIDE * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    offsets = pa.array(np.r_[starts, len(count)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, c) for c in (neighbour, count)]
    return pa.RecordBatch.from_arrays([item.take(pa.array(starts)), pa.array(part[starts].astype(np.int32)), *lists], ["item", "part", "neighbours", "counts"])


def _gather(batches):
    known: dict[str, int] = {}
    held = (np.empty(0, np.int64), np.empty(0, np.int64))  # pairs of codes, their counts
    n_baskets = 0

    def emit():
        pair, n = held
        if len(pair):
            names = pa.array(list(known), pa.string())
            part = np.fromiter((zlib.crc32(x.encode()) % SPREAD for x in known), np.int64, len(known))
            left, right = pair >> 32, pair & 0xFFFFFFFF
            order = np.lexsort((right, part[right], left))
            left, right, n = left[order], right[order], n[order]
            own = part[right]
            starts = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (own[1:] != own[:-1])])
            yield _rows(names.take(pa.array(left)), own, names.take(pa.array(right)), pa.array(n), starts)

    for batch in batches:
        lists, n_left = batch.column("items"), batch.column("left").to_numpy().astype(np.int64)
        n_baskets += pc.sum(batch.column("first")).as_py() or 0
        encoded = lists.flatten().dictionary_encode()
        lengths = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        starts = np.cumsum(lengths) - lengths
        if len(known) + len(encoded.dictionary) > HELD:
            yield from emit()
            known, held = {}, (np.empty(0, np.int64), np.empty(0, np.int64))
        remap = np.fromiter((known.setdefault(x, len(known)) for x in encoded.dictionary.to_pylist()), np.int64, len(encoded.dictionary))
        ids = remap[encoded.indices.to_numpy(zero_copy_only=False)]
        # Every left item, with the span of items at and after it.
        left_at = np.repeat(starts - np.cumsum(n_left) + n_left, n_left) + np.arange(n_left.sum())
        width = np.repeat(starts + lengths, n_left) - left_at
        ends = np.cumsum(width)
        a = 0
        while a < len(left_at):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK, side="right")))
            w = width[a:b]
            right_at = np.repeat(left_at[a:b] - np.cumsum(w) + w, w) + np.arange(w.sum())
            pair, at = np.unique(np.r_[held[0], ids[np.repeat(left_at[a:b], w)] << 32 | ids[right_at]], return_inverse=True)
            held = (pair, np.bincount(at, np.r_[held[1], np.ones(len(right_at), np.int64)], len(pair)).astype(np.int64))
            a = b
            if len(held[0]) > HELD:
                yield from emit()
                held = (np.empty(0, np.int64), np.empty(0, np.int64))
    yield from emit()
    if n_baskets:
        yield _rows(pa.array([""]), np.zeros(1, np.int32), pa.array([""]), pa.array([n_baskets]), np.zeros(1, np.int64))


def _merge(batches):
    held = None  # the counts of the last item and part, which may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("neighbours")
        row = pa.array(np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False)))
        flat = pa.table({"item": batch.column("item").take(row), "part": batch.column("part").take(row), "neighbour": lists.flatten(), "n": batch.column("counts").flatten()})
        whole = pa.concat_tables([held, flat]) if held is not None else flat
        sums = whole.group_by(["item", "part", "neighbour"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["item", "part", "neighbour", "n"])
        last = pc.and_(pc.equal(sums.column("item"), batch.column("item")[-1]), pc.equal(sums.column("part"), batch.column("part")[-1]))
        held = sums.filter(last)
        yield from _as_stripes(sums.filter(pc.invert(last)))
    if held is not None:
        yield from _as_stripes(held)


def _as_stripes(sums: pa.Table):
    if sums.num_rows:
        sums = sums.sort_by([("item", "ascending"), ("part", "ascending"), ("neighbour", "ascending")]).combine_chunks()
        item, part, neighbour, n = (sums.column(c).combine_chunks() for c in ("item", "part", "neighbour", "n"))
        code, own = item.dictionary_encode().indices.to_numpy(), part.to_numpy()
        yield _rows(item, own, neighbour, n, np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (own[1:] != own[:-1])]))


def item_pairs(baskets: DataFrame, min_count: int = 1, one_in: int | None = None, min_lift: float = 0.0) -> DataFrame:
    """(item_a, item_b, n, n_a, n_b, n_baskets, lift, llr) of the pairs item_a < item_b that share a basket.

    ``baskets``: one row per basket with ``items``, an array of distinct non-empty strings; empty arrays are
    no baskets. ``lift`` is n * N / (n_a * n_b), ``llr`` Dunning's log-likelihood ratio, signed: negative
    where the pair is rarer than chance. The thresholds (``min_count`` baskets, at least one basket ``one_in``
    so many, ``min_lift``) are applied to the whole counts; a pair is never
    dropped before it is counted. Stripes are gathered in each task, meet by item, and are merged there (see :func:`merged_stripes`). An empty table gives no rows.
    """
    filled = baskets.filter(F.size("items") > 0)
    whole = written(merged_stripes(stripes(filled)).select("item", "neighbours", "counts"))
    cells = whole.select("item", F.inline(F.arrays_zip("neighbours", F.col("counts").alias("n"))))
    single = cells.filter((F.col("item") == F.col("neighbours")) & (F.col("item") != "")).select("item", "n")
    total = cells.filter(F.col("item") == "").agg(F.sum("n").alias("n_baskets"))
    pairs = cells.filter((F.col("item") < F.col("neighbours")) & (F.col("item") != "")).select(F.col("item").alias("item_a"), F.col("neighbours").alias("item_b"), "n")
    pairs = pairs.crossJoin(F.broadcast(total)).filter(F.col("n") >= min_count)  # total: one row
    if one_in:
        pairs = pairs.filter(F.col("n") * one_in >= F.col("n_baskets"))
    pairs = pairs.join(single.select(F.col("item").alias("item_a"), F.col("n").alias("n_a")), "item_a").join(single.select(F.col("item").alias("item_b"), F.col("n").alias("n_b")), "item_b")
    scored = pairs.withColumn("lift", F.col("n") * F.col("n_baskets") / (F.col("n_a").cast("double") * F.col("n_b"))).withColumn("llr", _llr())
    return scored.filter(F.col("lift") >= min_lift).select("item_a", "item_b", "n", "n_a", "n_b", "n_baskets", "lift", "llr")


def _llr():
    """Signed 2 * sum(k * ln(k / expected)) over the four cells of the pair's contingency table."""
    n, a, b, t = (F.col(c).cast("double") for c in ("n", "n_a", "n_b", "n_baskets"))

    def cell(k, row, column):
        return F.when(k > 0, k * F.ln(k * t / (row * column))).otherwise(0.0)

    total = 2 * (cell(n, a, b) + cell(a - n, a, t - b) + cell(b - n, t - a, b) + cell(t - a - b + n, t - a, t - b))
    return F.when(n * t < a * b, -total).otherwise(total)
