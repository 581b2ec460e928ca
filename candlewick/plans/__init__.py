"""Plans: incremental builds, upserts, joins with size checks, the query registry."""
