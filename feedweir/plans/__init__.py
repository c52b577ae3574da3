"""Ready-made queries over the benchmark tables and the spec-driven ingest loop."""
