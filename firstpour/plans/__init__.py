"""Pipelines: loading one source, and loading a whole control table."""
