"""Registered queries: the package's operators run over the supplied tables."""
