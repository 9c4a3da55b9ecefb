"""Inputs, queries and SQL oracles of the driver contract."""
