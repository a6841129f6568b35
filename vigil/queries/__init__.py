"""Registered queries (one module per area); importing this package fills the registry."""

from vigil.queries import features, ingest, letters, model, profile, survival  # noqa: F401
