"""DataFrame operators: listings, threads, rendering, ordering and shards."""
