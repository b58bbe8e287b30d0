"""A PySpark engine for historised multi-tenant pipelines, with operators for training data."""
