"""Jobs put together from the operators: ingest, clean, curate and their reports."""
