"""Registered queries and the same results as DuckDB SQL."""
