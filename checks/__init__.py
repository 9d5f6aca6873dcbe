"""Registered queries and the DuckDB SQL they are compared with."""
