"""Checks of every operator on the test tables, each with its DuckDB counterpart."""
