"""Whole jobs: files in, result files out."""
