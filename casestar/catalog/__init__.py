"""Registered queries on the given tables, and the SQL each of them is checked against."""
