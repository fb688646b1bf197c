"""External programs over a table of jobs: the status table is the contract, the command is the caller's."""

from __future__ import annotations

import os
import shutil
import subprocess
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUS = "name string, status string, output string, runtime_sec double, error string"


def run_jobs(jobs: DataFrame, command: Callable[[dict], list[str]], timeout: float = 1800.0, dry_run: bool = False, tasks: int | None = None) -> DataFrame:
    """(name, status, output, runtime_sec, error) of every job (name, output, ...).

    ``command`` makes the argument list from a row. OK: exit code 0 and an output file that isn't empty;
    else FAILED, TIMEOUT or, with ``dry_run``, DRY_RUN. A job whose output exists already is OK at once, so a task that runs
    again doesn't repeat finished work; outputs must be in a folder all executors share.
    """

    def run(batches):
        for pdf in batches:
            rows = [_one(row, command, timeout, dry_run) for row in pdf.to_dict("records")]
            yield pd.DataFrame(rows, columns=["name", "status", "output", "runtime_sec", "error"])

    return (jobs.repartition(tasks) if tasks else jobs).mapInPandas(run, STATUS)


def _one(row: dict, command, timeout: float, dry_run: bool) -> dict:
    out = {"name": row["name"], "output": row.get("output"), "runtime_sec": 0.0, "error": None}
    done = lambda: bool(out["output"]) and os.path.exists(out["output"]) and os.path.getsize(out["output"]) > 0
    if dry_run:
        return out | {"status": "DRY_RUN"}
    if done():
        return out | {"status": "OK"}
    start = time.time()
    try:
        got = subprocess.run(command(row), capture_output=True, text=True, timeout=timeout)
        ok, error = got.returncode == 0 and done(), (got.stderr or "").strip()[-500:]
        out["error"] = None if ok else error or f"exit code {got.returncode}"
        status = "OK" if ok else "FAILED"
    except subprocess.TimeoutExpired:
        status, out["error"] = "TIMEOUT", f"more than {timeout:g} s"
    except OSError as e:
        status, out["error"] = "FAILED", str(e)
    return out | {"status": status, "runtime_sec": time.time() - start}


def status_counts(status: DataFrame) -> DataFrame:
    """One row: jobs by outcome, total and mean run time of finished ones."""
    ok = F.when(F.col("status") == "OK", F.col("runtime_sec"))
    return status.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in ("OK", "FAILED", "TIMEOUT", "DRY_RUN")],
        F.coalesce(F.sum("runtime_sec"), F.lit(0.0)).alias("total_sec"), F.avg(ok).alias("mean_sec"),
    )


def find_program(name: str, candidates: tuple[str, ...] = (), variable: str | None = None) -> str | None:
    """Path of a program: an environment variable, the search path, then the candidates."""
    named = os.environ.get(variable, "") if variable else ""
    for path in (named, shutil.which(name) or "", *candidates):
        if path and os.access(path, os.X_OK):
            return path
    return None


def formal_charge(properties: dict[str, str], keys: tuple[str, ...] = ("Formal_Charge", "FORMAL_CHARGE", "charge", "CHARGE")) -> int:
    """Charge from the first property that is a whole number, else 0."""
    for key in keys:
        try:
            return int(float(properties.get(key, "")))
        except ValueError:
            continue
    return 0
