"""Whole models: feature table, star schema, reports, forecasts."""
