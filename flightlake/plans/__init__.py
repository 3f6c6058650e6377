"""Plans: role views over the driver tables, join helpers, refresh job and the query registry."""
