"""Readers and writers: sheet exports, delimited landing files and warehouse tables."""
