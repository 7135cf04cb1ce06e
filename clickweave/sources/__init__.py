"""Readers and writers: log files, catalogues, packets, topics, marts."""
