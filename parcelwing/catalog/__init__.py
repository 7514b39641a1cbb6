"""Registered queries and the ANSI SQL that must give the same rows."""
