"""Labelled text corpora on Spark: audit, clean, split, export and score them."""

__version__ = "0.1.0"
