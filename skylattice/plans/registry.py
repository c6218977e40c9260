"""Every query of the engine by name, with its SQL."""

from __future__ import annotations

from importlib import import_module

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in ("pixel_queries", "raster_queries", "catalogue_queries", "verdict_queries", "product_queries", "source_queries", "comparison_queries", "stream_queries", "shape_queries", "matrix_queries", "naming_queries", "agreement_queries", "probe_queries"):
    _reg = import_module(f".{_name}", __package__).REG
    QUERIES |= _reg.queries
    SQL |= _reg.sql
