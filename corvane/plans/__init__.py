"""Registered queries: each reads the tables of a folder and returns a DataFrame."""
