"""Operators applied to the driver tables, each next to the SQL that must give the same rows."""
