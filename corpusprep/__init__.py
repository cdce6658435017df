"""Corpus preparation and language-model metrics as Spark DataFrame operators."""

__version__ = "0.1.0"
