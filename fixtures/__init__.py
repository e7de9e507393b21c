"""Manifests derived from the given tables, the registered queries on them, and their SQL counterparts."""
