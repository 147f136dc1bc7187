"""DataFrame operators: deduplication, content filter, sampling, shards, annotations, profiles."""
