"""Queries and their SQL of the training-data operators."""

from __future__ import annotations

from importlib import import_module

MODULES = ("packing", "resharding", "media", "warc", "ctw", "toxicity", "minhash", "suffixes", "decontamination", "quality", "occurrences", "phrases", "rtree")


def queries() -> dict:
    return {k: f for m in MODULES for k, f in import_module(f"{__package__}.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in import_module(f"{__package__}.{m}").ORACLES.items()}
