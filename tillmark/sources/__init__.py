"""Readers: raw files, lake tables, warehouse tables and streams."""
