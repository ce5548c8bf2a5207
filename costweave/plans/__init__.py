"""Queries over the star-schema tables, one per operator, with SQL oracles."""

import importlib

from pyspark import cloudpickle

import costweave

MODULES = ["pricing_queries", "profile_queries", "text_queries", "gate_queries", "audit_queries", "estimate_queries",
           "io_queries"]


def load_all() -> None:
    """Register all queries. Functions that run in Python workers travel by value, so that a session
    started elsewhere needs no copy of this package on its workers."""
    cloudpickle.register_pickle_by_value(costweave)
    for name in MODULES:
        importlib.import_module(f"costweave.plans.{name}")
