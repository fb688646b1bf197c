"""Classes of scores, distances and residues, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dominance(vdw: Column, es: Column, factor: float = 2.0) -> Column:
    """Which energy term outweighs the other by ``factor``."""
    return (
        F.when(vdw.isNull() | es.isNull(), "unknown")
        .when(F.abs(vdw) > factor * F.abs(es), "vdW_dominant")
        .when(F.abs(es) > factor * F.abs(vdw), "ES_dominant")
        .otherwise("balanced")
    )


def dominance_share(vdw: Column, es: Column, share: float = 0.65) -> Column:
    """The same by the share of the absolute sum; null without both terms."""
    total = F.abs(vdw) + F.abs(es)
    return F.when(total == 0, "balanced").when(F.abs(vdw) / total > share, "vdW").when(F.abs(es) / total > share, "ES").when(total.isNotNull(), "balanced")


def contact_class(distance: Column) -> Column:
    """Kind of contact by distance in Å."""
    return F.when(distance < 2.5, "strong_hbond").when(distance < 3.5, "hbond").when(distance < 4.5, "vdw").when(distance.isNotNull(), "weak")


def contact_energy_class(distance: Column, total: Column, near: float = 4.5, favourable: float = -0.5) -> Column:
    """Contact against energy; ``total`` null: no energy is known."""
    close, strong = distance <= near, total < favourable
    return (
        F.when(close & total.isNull(), "contact_only")
        .when(close & strong, "contact_and_energy")
        .when(close, "contact_no_energy")
        .when(strong, "long_range_ES")
        .otherwise("weak")
    )


def stability(convergence: Column) -> Column:
    return F.when(convergence >= 0.7, "STABLE").when(convergence >= 0.5, "MODERATE").when(convergence.isNotNull(), "UNSTABLE")


def correlation_words(r: Column) -> Column:
    size = F.abs(r)
    return F.when(size >= 0.7, "strong").when(size >= 0.4, "moderate").when(size.isNotNull(), "weak")


def energy_bin(total: Column) -> Column:
    return F.when(total < -1.0, "strong").when(total < -0.5, "moderate").when(total.isNotNull(), "weak")


def is_fragment_kind(label: Column, kind: str) -> Column:
    """``ring`` or ``linker``, by the label's prefix."""
    return F.coalesce(label.startswith(kind), F.lit(False))


def fragment_assessment(energy: Column, convergence: Column) -> Column:
    """What a fragment is good for, by its part of the affinity and its convergence; null without both."""
    return (
        F.when(energy.isNull() | convergence.isNull(), F.lit(None))
        .when((energy < -3.0) & (convergence >= 0.7), "Anchor")
        .when((energy < -2.0) & (convergence >= 0.7), "Reliable")
        .when((energy < -3.0) & (convergence < 0.5), "Potent but variable")
        .when(convergence < 0.3, "Unreliable")
        .when(convergence >= 0.7, "Stable, weak")
        .otherwise("Moderate")
    )


def residue_badge(energy: Column, consistency: Column) -> Column:
    """What a residue means for a molecule, by mean energy and the share of poses that favour it; null where nothing stands out."""
    return (
        F.when((energy < -5) & (consistency > 0.8), "Anchor")
        .when((energy < -2) & (consistency > 0.7), "Reliable")
        .when((energy < -5) & (consistency < 0.5), "Strong but variable")
        .when(consistency < 0.3, "Unreliable")
    )


def share_bin(share: Column, threshold: float = 0.8) -> Column:
    """Share of molecules that gain by a residue, in three bins."""
    return F.when(share >= threshold, "high").when(share >= 0.5, "medium").when(share.isNotNull(), "low")


def stamp(moment: Column | None = None) -> Column:
    """A moment (now, if none is given) as it stands in reports."""
    return F.date_format(moment if moment is not None else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
