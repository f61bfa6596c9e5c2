"""Readers: raw files, published lake tables, audit history."""
