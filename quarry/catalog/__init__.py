"""Named queries over the given tables, each with its SQL twin where SQL can say it."""

from importlib import import_module

MODULES = (
    "records",
    "curation",
    "tokens",
    "chat",
    "synthetic",
    "sharding",
    "rollouts",
    "retrieval",
    "tabular",
    "storage",
)


def all_queries():
    found = {}
    for name in MODULES:
        found.update(import_module(f"quarry.catalog.{name}").CATALOG.entries)
    return found
