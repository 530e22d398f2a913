"""Jobs (X1-X12), the feed encoding of the driver tables, and the
verification queries with their independent SQL oracles."""
