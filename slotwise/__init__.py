"""A PySpark engine for document-coverage ledgers."""
