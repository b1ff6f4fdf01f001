"""Readers, writers, storage layout and incremental loads."""
