"""Vessel-movement statistics as Spark DataFrame operators."""
