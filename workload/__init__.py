"""Registered queries over the given tables, and the SQL each must agree with."""
