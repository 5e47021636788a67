"""Queries over the supplied tables, each with the DuckDB SQL that must give the same rows."""
