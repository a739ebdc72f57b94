"""The products users see: daily ingest, warehouse models, report."""
