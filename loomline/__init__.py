"""Loomline: curation, matching and scoring of parallel text corpora on PySpark."""
