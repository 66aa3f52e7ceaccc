"""Named queries over the test tables, each with an optional SQL oracle."""

import importlib

from lexicrate.plans.registry import ORACLES, QUERIES

_MODULES = ["keyness_queries", "profile_queries", "textstats_queries", "tokens_queries",
            "features_queries", "dedup_queries",
            "eval_queries", "embed_queries", "models_io_queries", "scenario_queries"]
for _m in _MODULES:
    importlib.import_module(f"lexicrate.plans.{_m}")

__all__ = ["QUERIES", "ORACLES"]
