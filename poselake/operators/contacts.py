"""Contacts of molecules with residues: consensus, votes, heat map, and contacts against energies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import contact_energy_class
from ..session import written
from .ranking import top_per_group


def contact_consensus(contacts: DataFrame, molecule: str = "molecule_name", residue: str = "residue") -> DataFrame:
    """Residues by molecules that touch them: number, share of all molecules, mean distance and mean contacts."""
    n_all = contacts.agg(F.countDistinct(molecule).alias("n_all"))
    out = contacts.groupBy(residue).agg(F.countDistinct(molecule).alias("n_molecules"), F.avg("min_distance").alias("mean_distance"), F.avg("n_atom_contacts").alias("mean_contacts"))
    return out.crossJoin(F.broadcast(n_all)).withColumn("frac_molecules", F.col("n_molecules") / F.col("n_all")).drop("n_all")  # n_all: one row


def contact_votes(contacts: DataFrame, by: Sequence[str], molecule: str = "molecule_name", residue: str = "residue") -> DataFrame:
    """(by..., residue): distinct molecules and their share of the group's, distances, and the most frequent contact type (first by name on ties)."""
    sizes = contacts.groupBy(*by).agg(F.countDistinct(molecule).alias("n_group"))
    out = contacts.groupBy(*by, residue).agg(F.countDistinct(molecule).alias("n_molecules"), F.avg("min_distance").alias("mean_distance"), F.min("min_distance").alias("min_distance"))
    votes = contacts.filter("contact_type is not null").groupBy(*by, residue, "contact_type").agg(F.count(F.lit(1)).alias("n"))
    winner = votes.groupBy(*by, residue).agg(F.min_by("contact_type", F.struct(-F.col("n"), F.col("contact_type"))).alias("dominant_type"))
    out = out.join(sizes, list(by)).join(winner, [*by, residue], "left")
    return out.withColumn("frac_molecules", F.col("n_molecules") / F.col("n_group")).drop("n_group")


def member_contacts(members: DataFrame, contacts: DataFrame, keys: Sequence[str] = ("molecule_name", "fragment_id", "cluster_id")) -> DataFrame:
    """Contacts of the members of hotspots: inner join on molecule, fragment and cluster."""
    return members.join(contacts, list(keys))


def heat_map(contacts: DataFrame, residues: Sequence[str], molecule: str = "molecule_name", residue: str = "residue") -> DataFrame:
    """Least distance by molecule (rows) and the given residues (columns)."""
    return contacts.filter(F.col(residue).isin(list(residues))).groupBy(molecule).pivot(residue, list(residues)).agg(F.min("min_distance"))


def top_residues(contacts: DataFrame, k: int, molecule: str = "molecule_name", residue: str = "residue") -> list[str]:
    """The k residues most molecules touch: the columns of a heat map."""
    rows = contacts.groupBy(residue).agg(F.countDistinct(molecule).alias("n")).orderBy(F.desc("n"), residue).limit(k).collect()
    return [r[residue] for r in rows]


def heat_rows(contacts: DataFrame, k: int = 20, molecule: str = "molecule_name", residue: str = "residue") -> DataFrame:
    """(place, residue, molecule, min_distance): the heat map of the k residues that most molecules touch, as long rows; ``place`` starts at 1."""
    per = written(contacts.groupBy(residue, molecule).agg(F.min("min_distance").alias("min_distance")))  # read twice
    top = per.groupBy(residue).agg(F.count(molecule).alias("n")).orderBy(F.desc("n"), residue).limit(k)
    places = top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), residue))).drop("n")  # k rows
    return per.join(F.broadcast(places), residue).select("place", residue, molecule, "min_distance")


def nearest_residues(contacts: DataFrame, by: Sequence[str], k: int = 3, residue: str = "residue") -> DataFrame:
    """The k nearest residues of each fragment, one row for a residue."""
    per = contacts.groupBy(*by, residue).agg(F.min("min_distance").alias("min_distance"))
    return top_per_group(per, by, [F.col("min_distance").asc_nulls_last(), F.col(residue).asc()], k)


def contacts_and_energies(contacts: DataFrame, footprint: DataFrame, far: float = -0.5) -> DataFrame:
    """Contacts (name, residue_id, min_distance) with their pose's energy, and residues that act from afar.

    Energies are taken from the first pose of a (name, residue). Residues without contact come in, once per
    pose, where ``total < far``.
    """
    one = footprint.groupBy("name", "residue_id").agg(F.min_by(F.struct("pose_id", "vdw", "es", "total"), "pose_id").alias("e"))
    touching = contacts.join(one, ["name", "residue_id"], "left").select("name", "residue_id", F.col("e.pose_id").alias("pose_id"), "min_distance", "e.vdw", "e.es", "e.total")
    distant = footprint.join(contacts, ["name", "residue_id"], "left_anti").filter(F.col("total") < far).select("name", "residue_id", "pose_id", F.lit(None).cast("double").alias("min_distance"), "vdw", "es", "total")
    return touching.unionByName(distant).withColumn("category", contact_energy_class(F.col("min_distance"), F.col("total"), favourable=far))


def residue_importance(consensus: DataFrame, k: int = 20, size: str = "n_molecules", energy: str = "mean_total") -> DataFrame:
    """The k residues with the greatest product of reach and absolute mean energy."""
    return consensus.withColumn("importance", F.col(size) * F.abs(energy)).orderBy(F.desc("importance"), "residue_id").limit(k)


def share_of_group(df: DataFrame, value: str, by: Sequence[str], into: str = "share", least: float = 1e-10) -> DataFrame:
    """|value| as a share of its group's absolute sum; 0 where the sum is below ``least``."""
    total = F.sum(F.abs(value)).over(Window.partitionBy(*by))
    return df.withColumn(into, F.when(total > least, F.abs(value) / total).otherwise(0.0))
