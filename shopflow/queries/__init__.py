"""Registered queries, one per operator of the inventory."""

import importlib

FAMILIES = ["inputs", "tables", "clean", "quality", "features", "marts", "training", "metrics", "rag", "streaming"]


def load_all() -> None:
    for family in FAMILIES:
        importlib.import_module(f"shopflow.queries.{family}")
