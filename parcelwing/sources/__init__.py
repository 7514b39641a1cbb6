"""Schemas, table input and output, and the adapter for the generic test tables."""
