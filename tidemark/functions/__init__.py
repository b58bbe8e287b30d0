"""Column functions: fingerprints, projection, data quality."""
