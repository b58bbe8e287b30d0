"""Multi-step plans: ingest, build, rebuild."""
