"""fieldloom: a PySpark-native engine for captured airport pages, link tables and nested record feeds."""

__version__ = "0.1.0"
