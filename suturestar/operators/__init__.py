"""DataFrame-in, DataFrame-out operators: keys, SCD2, upsert, lookups, quality rules."""
