"""Readers, writers and generators of point sets and item streams."""

from .items import items, read_item_lines, read_items_checked
from .points import as_points, flat, read_points, write_points
from .generate import fair_gap_points

__all__ = ["items", "read_item_lines", "read_items_checked", "as_points", "flat", "read_points", "write_points", "fair_gap_points"]
