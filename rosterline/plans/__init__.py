"""Job flows, the binding of the given tables to the canonical schemas, and the query catalog."""
