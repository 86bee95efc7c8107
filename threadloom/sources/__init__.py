"""Readers and writers: batch files, ledgers and shards."""
