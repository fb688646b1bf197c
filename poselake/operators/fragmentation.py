"""Rigid fragments of a molecule's bond graph."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "name string, fragment_id int, label string, atom_indices array<int>, n_atoms int, is_ring boolean, is_linker boolean"


def rigid_fragments(n_atoms: int, bonds: list[tuple[int, int, bool]], ring: set[int], least: int = 4) -> list[dict]:
    """Parts between rotatable bonds (a, b, rotatable), those below ``least`` atoms merged into their largest neighbour.

    Parts are sorted by size, largest first (equal sizes by their first atom). A part is a ring if more than half of its atoms are, else
    a linker. A molecule without bonds is one part, ``whole_0``; without rotatable bonds, ``rigid_0``.
    """
    if n_atoms <= 0:
        return []
    every = list(range(n_atoms))
    if not bonds:
        return [{"label": "whole_0", "atoms": every, "is_ring": False, "is_linker": False}]
    if not any(r for _, _, r in bonds):
        return [{"label": "rigid_0", "atoms": every, "is_ring": 2 * len(ring) > n_atoms, "is_linker": False}]
    part = list(every)

    def find(i: int) -> int:
        while part[i] != i:
            part[i] = part[part[i]]
            i = part[i]
        return i

    for a, b, rotatable in bonds:
        if not rotatable:
            part[max(find(a), find(b))] = min(find(a), find(b))
    while True:
        groups: dict[int, list[int]] = {}
        for i in every:
            groups.setdefault(find(i), []).append(i)
        small = sorted((len(g), root) for root, g in groups.items() if len(g) < least)
        merged = False
        for _, root in small:
            near = {find(b if find(a) == root else a) for a, b, _ in bonds if (find(a) == root) != (find(b) == root)}
            if near:
                big = max(near, key=lambda r: (len(groups[r]), -r))
                part[max(root, big)] = min(root, big)
                merged = True
                break
        if not merged:
            break
    out, counts = [], {"ring": 0, "linker": 0}
    for g in sorted(groups.values(), key=lambda g: (-len(g), g[0])):
        kind = "ring" if 2 * len(ring & set(g)) > len(g) else "linker"
        out.append({"label": f"{kind}_{counts[kind]}", "atoms": g, "is_ring": kind == "ring", "is_linker": kind == "linker"})
        counts[kind] += 1
    return out


def fragment_molecules(molecules: DataFrame, least: int = 4) -> DataFrame:
    """Fragments of (name, n_atoms, bonds array<struct<a, b, rotatable>>, ring_atoms array<int>), heavy atoms from 0.

    Which bonds rotate and which atoms are in rings comes with the table; a molecule without bonds is one fragment.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for name, n, bonds, ring in zip(pdf["name"], pdf["n_atoms"], pdf["bonds"], pdf["ring_atoms"]):
                edges = [] if bonds is None else [(b["a"], b["b"], bool(b["rotatable"])) for b in bonds]
                for k, f in enumerate(rigid_fragments(int(n or 0), edges, set() if ring is None else set(map(int, ring)), least)):
                    rows.append((name, k, f["label"], f["atoms"], len(f["atoms"]), f["is_ring"], f["is_linker"]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return molecules.select("name", "n_atoms", "bonds", "ring_atoms").mapInPandas(run, SCHEMA)
