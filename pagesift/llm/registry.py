"""The training-data queries and their DuckDB SQL, gathered for registration."""

from __future__ import annotations

import importlib

MODULES = ("exact_dedup", "simhash", "langid", "mixing", "bpe", "toxicity", "ann",
           "chat", "pii", "lm", "records", "merkle",
           "spelling")

_loaded = [importlib.import_module(f"{__package__}.{m}") for m in MODULES]


def queries() -> dict:
    return {k: f for m in _loaded for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _loaded for k, s in m.ORACLES.items()}
