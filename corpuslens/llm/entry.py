"""Imports every operator module so that its query is registered."""

from __future__ import annotations

import importlib

from corpuslens.llm import common

_MODULES = ["mixing", "chat", "exact", "sharding", "simhash", "packing", "langid", "toxicity", "embeddings", "substrings",
            "bestfit", "merkle", "collocations"]


def _load():
    for m in _MODULES:
        importlib.import_module(f"corpuslens.llm.{m}")


def queries():
    _load()
    return dict(common.QUERIES)


def oracle_sql():
    _load()
    return dict(common.ORACLES)
