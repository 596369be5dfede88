from strata.streaming.ingest import checkpoint_path, ingest_landed  # noqa: F401
