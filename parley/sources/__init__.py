"""Readers and writers: transcript documents, table sinks, derived test views."""
