"""Imports every plan module so that all queries are registered."""

from __future__ import annotations

import importlib

from corpuslens.plans import registry

_MODULES = [
    "corpuslens.plans.evaluation",
    "corpuslens.plans.text_ops",
    "corpuslens.plans.segmentation",
    "corpuslens.plans.dense",
    "corpuslens.plans.phrase_queries",
    "corpuslens.plans.eda",
    "corpuslens.plans.evaltables",
    "corpuslens.plans.extract",
    "corpuslens.plans.metrics",
    "corpuslens.plans.prompt_queries",
    "corpuslens.plans.generation",
    "corpuslens.plans.stream_vectors",
]


def _load():
    for m in _MODULES:
        importlib.import_module(m)


def queries():
    _load()
    return dict(registry.QUERIES)


def oracle_sql():
    _load()
    return dict(registry.ORACLES)
