"""vigil: inspection-risk analytics as Spark DataFrame / SQL / ML jobs.

Layout:
  sources/    readers, the test-table adapter, catalog, sinks (keyed merge, versioned writes)
  functions/  Column -> Column cleaning expressions (no Python UDFs)
  operators/  loaders, integrity checks, letters, profiling, survival, model
  plans/      the point-in-time feature plan (site-day timeline + one running window)
  streaming/  incremental letter ingestion with Structured Streaming (availableNow)
"""

from vigil.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
