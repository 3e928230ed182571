"""Normalized relational tables, lookups and change records from typed model graphs, on Spark."""
