"""Earthquake data lake jobs and queries, written as PySpark DataFrame plans."""
