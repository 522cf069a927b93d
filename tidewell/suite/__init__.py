"""Registered queries over the given tables, with their SQL twins."""

from __future__ import annotations

import importlib

MODULES = ("lake", "serving", "changes", "masking", "secrets", "costs", "logs", "quality", "files", "streams", "star")


def load_all():
    from tidewell.suite import base

    for name in MODULES:
        importlib.import_module(f"tidewell.suite.{name}")
    return base.QUERIES, base.ORACLE
