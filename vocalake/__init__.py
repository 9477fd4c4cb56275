"""A PySpark engine for preparing speech and text corpora."""
