"""Relational operators: parity, audits, schema comparison, mapping, resolution, graphs."""
