"""User-level pipelines, each a chain of operators."""
