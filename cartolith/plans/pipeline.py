"""Runs layers: one driver thread each under fair scheduling, timed, reported, skipped where already whole."""

from __future__ import annotations

import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

from . import layers_land  # noqa: F401  registers its layers
from .layers import LAYERS, Catalog

SUCCESS, FAILED, PARTIAL = "SUCCESS", "FAILED", "PARTIAL_FAILURE"


def overall(states: list[str]) -> str:
    if all(s == SUCCESS for s in states):
        return SUCCESS
    return FAILED if all(s == FAILED for s in states) else PARTIAL


def write_json(path: str, said: dict) -> None:
    with open(f"{path}.partial", "w") as f:
        json.dump(said, f, indent=2)
    os.replace(f"{path}.partial", path)


def run_layers(cat: Catalog, out: str, names: list[str] | None = None, concurrency: int = 4, again: bool = False, summary: str | None = None, sizes: dict[str, int] | None = None) -> dict:
    """Writes each layer as Parquet under ``out``; the largest start first."""
    names = sorted(names or LAYERS, key=lambda n: (-(sizes or {}).get(n, 0), n))
    if unknown := set(names) - set(LAYERS):
        raise ValueError(f"unknown layers {sorted(unknown)}")

    def one(name: str) -> dict:
        began = time.time()
        path = f"{out}/{name}"
        jvm = cat.spark.sparkContext._jvm
        done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        try:
            if not again and done.getFileSystem(cat.spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
                return {"layer": name, "status": SUCCESS, "skipped": True, "seconds": 0.0}
            cat.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            cat.layer(name).write.mode("overwrite").parquet(path)
            return {"layer": name, "status": SUCCESS, "skipped": False, "seconds": round(time.time() - began, 3)}
        except Exception as e:  # one layer's failure is reported and leaves the others alone
            return {"layer": name, "status": FAILED, "error": str(e)[:500], "seconds": round(time.time() - began, 3)}

    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        runs = list(pool.map(one, names))
    said = {"status": overall([r["status"] for r in runs]), "layers": runs}
    if summary:
        write_json(summary, said)
    return said
