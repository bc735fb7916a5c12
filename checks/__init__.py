"""Registered queries over the given tables, each beside the SQL it must equal."""
