"""DataFrame operators: assignment, objectives, k-means, fair k-means, sketches, heavy hitters."""

from . import assign, cluster, fair, heavy, objective, sketch

__all__ = ["assign", "cluster", "fair", "heavy", "objective", "sketch"]
