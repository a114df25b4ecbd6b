"""millrace: a PySpark engine for building and auditing multimodal training data."""
