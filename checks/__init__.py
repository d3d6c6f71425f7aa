"""Registered queries over the given tables, and the SQL that must agree with them."""
