"""Column-level building blocks: names, types, missing values, literals, hashes, conversions."""
