"""Structured Streaming drivers for histograms and sketches."""

from .stream import file_stream, histogram_state, latest, prefix, run_state, run_until, sketch_state, taken

__all__ = ["file_stream", "histogram_state", "latest", "prefix", "run_state", "run_until", "sketch_state", "taken"]
