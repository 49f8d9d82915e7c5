"""Column-expression building blocks."""

from .hashing import HashFamily, SketchSpec
from .vectors import sq_dist

__all__ = ["HashFamily", "SketchSpec", "sq_dist"]
