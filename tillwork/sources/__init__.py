"""Readers, the table store and the report writer."""
