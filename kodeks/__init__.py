"""Kodeks: a PySpark-native engine for incremental legal-document corpora."""

__version__ = "0.1.0"
