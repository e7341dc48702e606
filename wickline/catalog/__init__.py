"""The registered queries and their independent SQL twins.

Each section module has ``QUERIES`` (name -> function of session and data folder) and ``ORACLES``
(name -> DuckDB SQL). Every query reads whole tables.
"""

from __future__ import annotations

from importlib import import_module

SECTIONS = ["ingest", "cleaning", "checks", "loading", "rankings", "samples", "preparation", "training",
            "evaluation", "deployment", "watching", "streams"]



def collect() -> tuple[dict, dict]:
    queries, oracles = {}, {}
    for name in SECTIONS:
        module = import_module(f"wickline.catalog.{name}")
        queries.update(module.QUERIES)
        oracles.update(module.ORACLES)
    return queries, oracles
