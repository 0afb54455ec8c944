"""A PySpark engine for captured market-data tapes."""
