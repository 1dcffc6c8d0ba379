"""Queries that run the operators over the shared tables."""

from __future__ import annotations

import importlib

MODULES = ("expressions", "texts", "scanning", "facts", "jobs", "layers")


def load():
    """(queries, sql twins) of every binding module."""
    from concordat.bindings import registry

    for m in MODULES:
        importlib.import_module(f"concordat.bindings.{m}")
    return dict(registry.QUERIES), dict(registry.TWINS)
