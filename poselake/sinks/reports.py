"""HTML reports of a campaign: small tables and bars drawn from them, one page each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STYLE = "body{font-family:sans-serif;margin:2em;max-width:70em}table{border-collapse:collapse}td,th{padding:.2em .6em;border-bottom:1px solid #ddd;text-align:right}td:first-child,th:first-child{text-align:left}.card{display:inline-block;padding:.6em 1em;margin:.3em;background:#f2f4f7;border-radius:.4em}"


def rows_of(df: DataFrame, k: int) -> list[dict]:
    """The first ``k`` rows: all that a report brings to the driver."""
    return [r.asDict() for r in df.limit(k).collect()]


def table(rows: Sequence[Mapping], title: str) -> str:
    if not rows:
        return f"<h2>{escape(title)}</h2><p>no rows</p>"
    show = lambda v: "" if v is None else escape(f"{v:.3f}" if isinstance(v, float) else str(v))
    head = "".join(f"<th>{escape(c)}</th>" for c in rows[0])
    body = "".join("<tr>" + "".join(f"<td>{show(v)}</td>" for v in r.values()) + "</tr>" for r in rows)
    return f"<h2>{escape(title)}</h2><table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"


def bars(rows: Sequence[Mapping], label: str, value: str, title: str, width: int = 420) -> str:
    """Horizontal bars as inline SVG; negative values go to the left of the axis."""
    shown = [(str(r[label]), float(r[value])) for r in rows if r.get(value) is not None]
    if not shown:
        return ""
    low, high = min(0.0, *(v for _, v in shown)), max(0.0, *(v for _, v in shown))
    scale = width / ((high - low) or 1.0)
    parts = [
        f'<text x="150" y="{20 * i + 14}" text-anchor="end" font-size="11">{escape(n[:24])}</text><rect x="{160 + (min(v, 0.0) - low) * scale:.1f}" y="{20 * i + 3}" width="{abs(v) * scale:.1f}" height="14" fill="#4c78a8"><title>{v:.3f}</title></rect>'
        for i, (n, v) in enumerate(shown)
    ]
    return f'<h3>{escape(title)}</h3><svg width="{width + 180}" height="{20 * len(shown) + 6}">{"".join(parts)}</svg>'


def cards(values: Mapping[str, object]) -> str:
    return "".join(f'<span class="card"><b>{escape(str(v if not isinstance(v, float) else round(v, 3)))}</b><br>{escape(k)}</span>' for k, v in values.items())


def page(title: str, *parts: str, stamp: str = "") -> str:
    return f'<!doctype html><html><head><meta charset="utf-8"><title>{escape(title)}</title><style>{_STYLE}</style></head><body><h1>{escape(title)}</h1><p>{escape(stamp)}</p>{"".join(parts)}</body></html>'


def grid_engine_report(composite: DataFrame, consensus: DataFrame, modes: DataFrame | None = None, k: int = 20, stamp: str = "") -> str:
    """The grid docking engine's campaign: cards, best molecules, consensus residues, binding modes."""
    best = rows_of(composite.orderBy(F.col("composite_score").asc_nulls_last(), "name"), k)
    residues = rows_of(consensus.orderBy(F.col("mean_total").asc_nulls_last(), "residue_id"), 25)
    head = {"molecules": composite.count(), "residues": consensus.count(), "best": best[0]["composite_score"] if best else None}
    return page("Grid docking campaign", cards(head), table(best, f"Best {k} molecules"), bars(best, "name", "composite_score", "Composite scores"), table(residues, "Consensus residues"), bars(residues, "residue_id", "mean_total", "Mean energy by residue"), *([table(rows_of(modes.orderBy("name"), k), "Binding modes")] if modes is not None else []), stamp=stamp)


def cnn_engine_report(composite: DataFrame, hotspots: DataFrame | None = None, contacts: DataFrame | None = None, k: int = 20, stamp: str = "") -> str:
    """The CNN docking engine's campaign: composite of affinity and convergence, hotspots, residues in contact."""
    best = rows_of(composite.orderBy("rank"), k)
    parts = [table(best, f"Best {k} molecules"), bars(best, "name", "composite_score", "Affinity times convergence")]
    if hotspots is not None:
        spots = rows_of(hotspots.orderBy("number"), k)
        parts += [table(spots, "Hotspots"), bars(spots, "number", "n_molecules", "Molecules by hotspot")]
    if contacts is not None:
        near = rows_of(contacts.orderBy(F.desc("frac_molecules"), contacts.columns[0]), k)
        parts += [table(near, "Residues in contact"), bars(near, contacts.columns[0], "frac_molecules", "Share of molecules by residue")]
    return page("CNN docking campaign", cards({"molecules": composite.count()}), *parts, stamp=stamp)


def comparison_report(consensus: DataFrame, overlaps: DataFrame, agreement: DataFrame | None = None, k: int = 20, stamp: str = "") -> str:
    """Both engines side by side: molecules in several lists, how the lists overlap, rank correlation."""
    hits = rows_of(consensus.filter("n_lists >= 2").orderBy("consensus_rank"), k)
    counts = rows_of(consensus.groupBy("n_lists").agg(F.count(F.lit(1)).alias("n")).orderBy("n_lists"), 10)
    return page("Comparison of the engines", table(hits, "Consensus hits"), table(counts, "Molecules by number of lists"), bars(counts, "n_lists", "n", "Molecules by number of lists"), table(rows_of(overlaps, 50), "Overlap of the lists"), *([table(rows_of(agreement, 5), "Agreement")] if agreement is not None else []), stamp=stamp)


def footprint_report(consensus: DataFrame, pharmacophore: DataFrame, zones: DataFrame | None = None, k: int = 25, stamp: str = "") -> str:
    """Per-residue energies: consensus, pharmacophore residues, zones."""
    residues = rows_of(consensus.orderBy(F.col("mean_total").asc_nulls_last(), "residue_id"), k)
    return page("Residue energies", cards({"residues": consensus.count(), "pharmacophore residues": pharmacophore.count()}), table(residues, "Strongest residues"), bars(residues, "residue_id", "mean_total", "Mean energy"), table(rows_of(pharmacophore, k), "Pharmacophore"), *([table(rows_of(zones, k), "Zones")] if zones is not None else []), stamp=stamp)


def hotspot_scene(spots: Sequence[tuple[int, float, float, float, float]], receptor: str | None = None, bild: str = "hotspots.bild") -> tuple[str, str]:
    """(commands, scene) for a molecule viewer: the receptor as a surface, hotspots (number, x, y, z, radius) as spheres with their numbers."""
    commands = [f"open {receptor}", "color #1 light gray", "surface #1", "transparency #1 70"] if receptor else []
    commands += [f"open {bild}", "view"]
    colours = ("red", "orange", "yellow", "green", "cyan", "blue", "purple", "magenta")
    scene = [line for n, x, y, z, r in spots for line in (f".color {colours[n % len(colours)]}", ".transparency 0.5", f".sphere {x:.3f} {y:.3f} {z:.3f} {r:.2f}", f".cmov {x:.3f} {y:.3f} {z:.3f}", f"H{n}")]
    return "\n".join(commands) + "\n", "\n".join(scene) + "\n"
