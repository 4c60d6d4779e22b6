"""Reusable DataFrame operators: validation, velocity, joins, constraints, schema evolution."""
