"""The data jobs: ingest, statistics, search documents, factors, scoring."""
