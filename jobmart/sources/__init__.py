"""Readers, column mapping and table writes."""
