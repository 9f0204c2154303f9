"""Readers and writers: driver tables, TREC-text corpora, topic files, run files."""
