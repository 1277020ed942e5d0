"""Imports every query module so that the registry is filled."""

from importlib import import_module

from .registry import ORACLES, QUERIES

MODULES = ("splat_queries", "voxel_queries", "run_queries", "delivery_queries", "frame_queries", "sfm_queries", "source_queries", "stream_queries")
for _module in MODULES:
    import_module(f"{__package__}.{_module}")

__all__ = ["QUERIES", "ORACLES"]
