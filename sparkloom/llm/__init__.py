"""Operators for preparing training text. `queries.QUERIES` binds them to the test tables."""
