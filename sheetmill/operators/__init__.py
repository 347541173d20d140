"""DataFrame operators: ingest, profile, validate, type, deduplicate, control, audit."""
