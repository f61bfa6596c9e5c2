"""Whole-table jobs, audit, gold tables and analytical queries."""
