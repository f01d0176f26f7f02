"""Compositions of the operators.

importer   the import modes P1-P6 (full, dev, only editions/authors/works, guard)
carriers   dump lines derived from the driver's tables (for checks and the bench)
registry   the registered queries with their DuckDB oracles
"""
