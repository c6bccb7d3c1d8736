"""DataFrame operators: cleaning, latest values, upserts, dimensions, fact, checks."""
