"""The jobs: ingest, clean, dimensions, fact, serving, dashboard."""
