"""Structured Streaming jobs (H1-H5) built from the same batch transformations."""
