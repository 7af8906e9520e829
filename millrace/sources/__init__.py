"""Readers: delimited files, document collections, document columns, catalog."""
