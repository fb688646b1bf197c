"""Pieces of SQL, and rounding that both engines agree on."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def LATEST(table: str, key: Sequence[str], columns: str = "*") -> str:  # noqa: N802
    """The counting rows; more conditions may follow after AND."""
    return f"SELECT {columns} FROM {table} QUALIFY row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY loaded_at DESC NULLS LAST) = 1"


def LATEST_OK(table: str, key: Sequence[str], columns: str = "*") -> str:  # noqa: N802
    """The counting rows whose key has no null."""
    return LATEST(table, key, columns) + "".join(f" AND {k} IS NOT NULL" for k in key)


#: The counting rows of the cross-engine ranking that have a name: rows without a source file are nobody's copies, so all stay.
RANKING = "SELECT * FROM cross_engine_ranking QUALIFY name IS NOT NULL AND (source_file IS NULL OR row_number() OVER (PARTITION BY source_file, name ORDER BY loaded_at DESC NULLS LAST) = 1)"


def _grid(digits: int) -> int:
    return 1 << round(digits * 3.3219)


def rounded(sql: str) -> str:
    """``round(x, @digits)`` of a query as :func:`r` has it: x to the nearest multiple of a power of two."""
    while m := re.search(r", @(\d)\)", sql):
        at, depth = m.start(), 1
        while depth:
            at -= 1
            depth += {")": 1, "(": -1}.get(sql[at], 0)
        assert sql[at - 5 : at] == "round", sql[at - 20 : m.end()]
        n = _grid(int(m[1]))
        sql = f"{sql[: at - 5]}(floor(CAST({sql[at + 1 : m.start()]} AS DOUBLE) * {n} + 0.5) / {n}){sql[m.end() :]}"
    return sql


def r(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    """``columns`` to the nearest multiple of a power of two (2^-30 for 9 digits), so that the last bits of floating sums don't matter.

    Means of short decimals often lie half-way between two decimals, but half-way between two such multiples only where
    they are sums of powers of two, and these every engine adds up exactly.
    """
    n = float(_grid(digits))
    return df.withColumns({c: F.floor(F.col(c) * n + 0.5) / n for c in columns})
