"""Residue and contact terms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN = r"^[A-Z]+[1-9][0-9]*\.[A-Z]$"
_BREAKS = r"[\s :/_.\-,;|]+"
_NAME_FIRST = r"^([A-Z0-9]*[A-Z]) ?0*([0-9]+) ?([A-Z]|(?<= )[A-Z0-9]{1,4})$"
_CHAIN_FIRST = r"^([A-Z0-9]{1,4}) ([A-Z0-9]*[A-Z]) ?0*([0-9]+)$"


def residue_term(raw: Column) -> Column:
    """``NAME`` + number + ``.`` + chain in upper case; null for null and blank values.

    Letter case, blanks, separators, leading zeros and the order of the parts don't matter. What can't be
    read as a residue stays a term of its own: upper case, breaks as single dots.
    """
    upper = F.upper(raw)
    flat = F.trim(F.regexp_replace(upper, _BREAKS, " "))
    parsed = (
        F.when(flat == "", F.lit(None))
        .when(flat.rlike(_NAME_FIRST), F.regexp_replace(flat, _NAME_FIRST, "$1$2.$3"))
        .when(flat.rlike(_CHAIN_FIRST), F.regexp_replace(flat, _CHAIN_FIRST, "$2$3.$1"))
        .otherwise(F.regexp_replace(flat, " ", "."))
    )
    return F.when(raw.rlike(_PLAIN), raw).when(raw.isNotNull(), parsed)


def contact_term(raw: Column) -> Column:
    """Lower case with ``_`` between the words; null for null and blank values."""
    words = F.regexp_replace(F.regexp_replace(F.lower(raw), r"[^\p{L}\p{N}]+", "_"), r"^_+|_+$", "")
    return F.when(raw.rlike(r"^[a-z]+$"), raw).when(words != "", words)


def residue_id(name: Column, number: Column, chain: Column) -> Column:
    """Build ``TRP392.A`` from its parts."""
    return F.format_string("%s%d.%s", name, number.cast("int"), chain)


def residue_parts(residue: Column) -> Column:
    """Struct(residue_name, residue_number, chain) of a ``TRP392.A``; nulls where it doesn't parse."""
    pattern = r"^([A-Z]{1,4})(-?\d+)\.(\w+)$"

    def part(k: int) -> Column:
        return F.nullif(F.regexp_extract(residue, pattern, k), F.lit(""))

    return F.struct(part(1).alias("residue_name"), part(2).cast("int").alias("residue_number"), part(3).alias("chain"))
