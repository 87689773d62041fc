"""Registered queries; load() imports every module that registers some."""

import importlib

MODULES = ["point_queries", "mesh_queries", "cloud_queries", "file_queries", "flow_queries", "format_queries", "search_queries"]


def load() -> None:
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
