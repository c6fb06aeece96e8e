"""Job chains: ``daily`` (every job for a date, backfills, ingest) and
``registry`` (named queries over the test tables)."""
