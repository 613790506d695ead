"""DataFrame operators: keys, deduplication, lookups, output contracts."""
