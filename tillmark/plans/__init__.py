"""Whole jobs, and the mapping of the test tables onto the data model."""
