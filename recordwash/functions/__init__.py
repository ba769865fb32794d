"""Column -> Column functions; all native expressions, no Python UDF."""
