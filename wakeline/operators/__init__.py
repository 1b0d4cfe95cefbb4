"""Operators: DataFrames and parameters in, one DataFrame out.

They run no job, but for ``positions_by_port``, which counts the cells of its ports.
"""
