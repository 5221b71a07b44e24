"""Readers for warehouse tables, landed files and databases."""
