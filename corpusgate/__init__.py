"""Governed text corpora on Spark: ingest, parse, filter, sample, review, join, audit."""
