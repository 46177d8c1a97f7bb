"""Readers and writers for the record kinds in ``tagloom.schemas``."""
