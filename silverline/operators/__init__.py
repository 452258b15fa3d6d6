"""DataFrame operators: shaping, deduplication, skew-safe joins, counting."""
