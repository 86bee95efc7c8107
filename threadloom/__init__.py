"""Forum-thread curation as Spark jobs: ingest, clean, render and shard."""
