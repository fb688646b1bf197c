"""How often every distinct term occurs, and in how many records."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, written


def term_pairs(df: DataFrame, fields: dict[str, Column], record: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """(field, term, record, n): occurrences by term and record, counted within each partition of ``keep``.

    One more row per record, with a null field, stands for the record itself: it lets the same scan count
    the records, those without any term included.
    """
    counted = [F.struct(F.lit(name).alias("field"), term.alias("term")) for name, term in fields.items()]
    counted.append(F.struct(F.lit(None).cast("string").alias("field"), F.lit("").alias("term")))
    pairs = df.select(*keep, record.alias("record"), F.inline(F.array(*counted)))
    pairs = pairs.filter(F.col("term").isNotNull() & (F.col("field").isNotNull() | F.col("record").isNotNull()))
    return pairs.groupBy(*keep, "field", "term", "record").agg(F.count(F.lit(1)).alias("n")).drop(*keep)


def term_frequencies(pairs: DataFrame, rare_below: int = 5, common_percent: int = 30) -> DataFrame:
    """(field_name, term, n_occurrences, n_records, share, mark) of every term of ``pairs`` (see term_pairs).

    Range-partitioned external sort with a run-length scan. The range is over (field, term, record), so a
    term that holds a third of all rows is spread over as many partitions as its records need, while one
    (term, record) pair never straddles a boundary; each partition is sorted (spilling), and one scan over
    the sorted rows finds where runs of a term and of a record begin and adds them up, with one row of
    state. Only a row per term, partition and Arrow batch is exchanged after that.

    ``mark`` is ``rare`` below ``rare_below`` records, else ``common`` above ``common_percent`` percent of
    all records, else null. Null terms are no terms. An occurrence without a record (null) counts as an
    occurrence only. An empty table gives no rows. ``share`` is null if there are no records.
    """
    order = ["field", "term", "record"]
    in_order = written(pairs).repartitionByRange(*order).sortWithinPartitions(*order)  # read twice: for the ranges, and to send
    runs = in_order.select(*order, "n").mapInArrow(_scan_runs, "field string, term string, n_occurrences bigint, n_records bigint")
    per_term = cut(runs.groupBy("field", "term").agg(F.sum("n_occurrences").alias("n_occurrences"), F.sum("n_records").alias("n_records")))
    total = per_term.filter(F.col("field").isNull()).agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_all"))
    share = F.when(F.col("n_all") > 0, F.col("n_records") / F.col("n_all"))
    mark = F.when(F.col("n_records") < rare_below, "rare").when(100 * F.col("n_records") > common_percent * F.col("n_all"), "common")
    return (
        per_term.filter(F.col("field").isNotNull())
        .crossJoin(F.broadcast(total))  # one row, from a global aggregate
        .select(F.col("field").alias("field_name"), "term", "n_occurrences", "n_records", share.alias("share"), mark.alias("mark"))
    )


def _scan_runs(batches):
    """(field, term, occurrences, records) of each run of a term in a sorted partition; a run is cut where a batch ends."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.RecordBatch.from_arrays([pa.concat_arrays([last.column(i), batch.column(i)]) for i in range(4)], batch.schema.names) if last else batch
        term = _changes(whole.column(0)) | _changes(whole.column(1))
        record = (term | _changes(whole.column(2)))[1 if last else 0 :] & np.asarray(batch.column(2).is_valid())
        starts = np.flatnonzero(np.r_[True, term[2 if last else 1 :]])
        n = batch.column(3).to_numpy()
        at = pa.array(starts)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.add.reduceat(n, starts)), pa.array(np.add.reduceat(record.astype(np.int64), starts))], ["field", "term", "n_occurrences", "n_records"])
        last = batch.slice(batch.num_rows - 1)


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; nulls are equal; the first always differs."""
    valid = np.asarray(column.is_valid())
    differ = np.asarray(pc.fill_null(pc.not_equal(column[1:], column[:-1]), False))
    return np.r_[True, differ | (valid[1:] != valid[:-1])]
